"""Queries of the corpus operators over the driver's tables, with their SQL twins.

Stand-ins: a label and a transcript with the same directory and base name are a text file beside its JSON; rows of
aligned_transcripts are round-1 JSON files; documents are text files below their source; event values are durations in seconds;
embeddings are signals, spectra and class scores. A row with a null path is no file and takes no part in queries on files; a row that
comes twice counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phonoloom.functions import paths, text
from phonoloom.operators import agreement, curate, profile, progress, signal, transcript
from phonoloom.session import table

WANTED_LANGUAGE, MOST_EDITS = "hu", 2


def _labels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "text_labels").filter("path IS NOT NULL").select("label_id", "path", "text").distinct()
    return rows.select("label_id", "path", "text", *paths.parts(F.col("path")))


def _scripts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "transcripts").filter("path IS NOT NULL").select("transcript_id", "path", "language", "segments").distinct()
    return rows.select("transcript_id", "path", "language", "segments", *paths.parts(F.col("path")))


def _catalog(spark: SparkSession, d: str) -> DataFrame:
    both = _labels(spark, d).select("path", "dir", "base", "ext").unionByName(_scripts(spark, d).select("path", "dir", "base", "ext"))
    return both.distinct()


def _aligned(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "aligned_transcripts").select("align_id", "word_segments").dropDuplicates(["align_id"])


_P = lambda c: f"replace({c}, chr(92), '/')"
_DIR = lambda c: f"regexp_extract({_P(c)}, '^(.*)/[^/]*$', 1)"
_BASE = lambda c: f"regexp_extract({_P(c)}, '([^/]*)[.][^./]*$', 1)"
_EXT = lambda c: f"lower(regexp_extract({_P(c)}, '[.]([^./]*)$', 1))"
_SP = r"[\s\p{Z}\x1C-\x1F\x{85}]"
_STRIP = lambda c: f"regexp_replace({c}, '^{_SP}+|{_SP}+$', '', 'g')"
_NORM = lambda c: f"lower({_STRIP(f"regexp_replace({c}, '{_SP}+', ' ', 'g')")})"
# DuckDB's distance counts bytes: both texts are written with a single-byte stand-in for each code point of the pair first.
_CHARS = lambda c: f"list_transform(range(1, length({c}) + 1), lambda i: substring({c}, i, 1))"
_LABELS = f"lab AS (SELECT DISTINCT label_id, path, text, {_DIR('path')} AS dir, {_BASE('path')} AS base, {_EXT('path')} AS ext FROM text_labels WHERE path IS NOT NULL)"
_SCRIPTS = f"scr AS (SELECT DISTINCT transcript_id, path, language, segments, {_DIR('path')} AS dir, {_BASE('path')} AS base, {_EXT('path')} AS ext FROM transcripts WHERE path IS NOT NULL)"
_CATALOG = f"{_LABELS}, {_SCRIPTS}, cat AS (SELECT path, dir, base, ext FROM lab UNION SELECT path, dir, base, ext FROM scr)"


# Agreement ---------------------------------------------------------------------------------------------------------


def _matched(spark: SparkSession, d: str, edits: int = 0) -> DataFrame:
    pairs = _labels(spark, d).select("dir", "base", "label_id", "text").join(_scripts(spark, d).select("dir", "base", "transcript_id", "language", "segments"), ["dir", "base"])
    return agreement.matches(agreement.line_pairs(pairs, ["label_id", "transcript_id"], "text", "segments", "language"), edits)


def transcript_agreement_by_lang(spark: SparkSession, d: str, edits: int = 0) -> DataFrame:
    out = agreement.by_language(_matched(spark, d, edits))
    shares = ("exact_pct", "normalized_pct", "unmatched_share", "exact_share", "normalized_share")
    return out.select("lang", "lines", "exact", "normalized", *(F.round(c, 6).alias(c) for c in shares))


def fuzzy_agreement_by_lang(spark: SparkSession, d: str) -> DataFrame:
    return transcript_agreement_by_lang(spark, d, MOST_EDITS)


def transcript_agreement_totals(spark: SparkSession, d: str) -> DataFrame:
    return agreement.totals(_matched(spark, d), ["label_id", "transcript_id"])


def drop_unmatched_groups(spark: SparkSession, d: str) -> DataFrame:
    return agreement.unmatched(_matched(spark, d), ["label_id", "transcript_id"])


def fuzzy_unmatched_groups(spark: SparkSession, d: str) -> DataFrame:
    return agreement.unmatched(_matched(spark, d, MOST_EDITS), ["label_id", "transcript_id"])


_LINES = f"""{_LABELS}, {_SCRIPTS},
pr AS (SELECT label_id, transcript_id, coalesce(language, 'UNKNOWN') AS lang, segments,
       string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)) AS raw FROM lab JOIN scr USING (dir, base)),
pl AS (SELECT label_id, transcript_id, lang, segments, CASE WHEN raw[-1] = '' THEN raw[:-2] ELSE raw END AS ls FROM pr),
px AS (SELECT label_id, transcript_id, lang, ls, segments, unnest(range(least(len(ls), len(segments)))) AS line_no FROM pl),
py AS (SELECT label_id, transcript_id, lang, line_no, {_STRIP('ls[line_no + 1]')} AS a, {_STRIP("coalesce(segments[line_no + 1].text, '')")} AS b FROM px),
pz AS (SELECT *, {_NORM('a')} AS na, {_NORM('b')} AS nb FROM py)"""
_MATCHED = f"{_LINES}, mt AS (SELECT *, a = b AS is_exact, a = b OR na = nb AS is_norm FROM pz)"
_FUZZY = f"""{_LINES},
pc AS (SELECT *, abs(length(na) - length(nb)) <= {MOST_EDITS} AND na <> nb AS close FROM pz),
pd AS (SELECT *, CASE WHEN close THEN list_distinct({_CHARS('na || nb')}) END AS cs FROM pc),
pe AS (SELECT *, CASE WHEN len(cs) > 127 THEN error('too many characters') WHEN close THEN list_aggregate(cs, 'string_agg', '') END AS frm,
       CASE WHEN close THEN list_aggregate(list_transform(range(1, len(cs) + 1), lambda i: chr(CAST(i AS INTEGER))), 'string_agg', '') END AS too FROM pd),
mt AS (SELECT *, a = b AS is_exact, a = b OR na = nb OR (close AND levenshtein(translate(na, frm, too), translate(nb, frm, too)) <= {MOST_EDITS}) AS is_norm FROM pe)"""
_BY_LANG = lambda m: f"""WITH {m}, g AS (SELECT lang, count(*) AS lines, CAST(count_if(is_exact) AS BIGINT) AS exact, CAST(count_if(is_norm) AS BIGINT) AS normalized FROM mt GROUP BY lang)
SELECT lang, lines, exact, normalized, round(100.0::DOUBLE * exact / lines, 6) AS exact_pct, round(100.0::DOUBLE * normalized / lines, 6) AS normalized_pct,
round(100.0::DOUBLE * (lines - exact) / nullif(sum(lines - exact) OVER (), 0), 6) AS unmatched_share, round(100.0::DOUBLE * exact / nullif(sum(exact) OVER (), 0), 6) AS exact_share,
round(100.0::DOUBLE * normalized / nullif(sum(normalized) OVER (), 0), 6) AS normalized_share FROM g"""  # noqa: E731


# Sentences and chunks ----------------------------------------------------------------------------------------------


def sentence_segments(spark: SparkSession, d: str) -> DataFrame:
    return transcript.exploded(transcript.with_sentences(_aligned(spark, d), "word_segments"), "align_id", F.col("sentences"), "sentence_no")


def greedy_chunks(spark: SparkSession, d: str) -> DataFrame:
    return transcript.exploded(transcript.with_sentences(_aligned(spark, d), "word_segments"), "align_id", transcript.chunks(F.col("sentences")), "chunk_no")


def legacy_sentences(spark: SparkSession, d: str) -> DataFrame:
    return transcript.exploded(transcript.with_legacy_sentences(_aligned(spark, d), "word_segments"), "align_id", F.col("sentences"), "sentence_no")


def short_chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = greedy_chunks(spark, d).select(transcript.chunk_status(F.col("start_ms"), F.col("end_ms")).alias("status"))
    return rows.groupBy("status").agg(F.count("*").alias("chunks"))


_WORDS = f"""al AS (SELECT align_id, any_value(word_segments) AS ws FROM aligned_transcripts GROUP BY align_id),
w0 AS (SELECT align_id, unnest(ws) AS u, unnest(range(len(ws))) AS pos, len(ws) AS n FROM al),
w AS (SELECT align_id, pos, n, {_STRIP("coalesce(u.word, '')")} AS word, CASE WHEN isnan(u.start) THEN NULL ELSE u.start END AS s, CASE WHEN isnan(u."end") THEN NULL ELSE u."end" END AS e FROM w0)"""
_SENTENCES = f"""{_WORDS},
wt AS (SELECT *, regexp_matches(word, '[.!?]$') OR pos = n - 1 AS b FROM w WHERE s IS NOT NULL AND e IS NOT NULL),
wi AS (SELECT *, coalesce(sum(CASE WHEN b THEN 1 ELSE 0 END) OVER (PARTITION BY align_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sid FROM wt),
st AS (SELECT align_id, CAST(sid AS INTEGER) AS sentence_no, CAST(trunc(first(s ORDER BY pos) * 1000) AS BIGINT) AS start_ms, CAST(trunc(last(e ORDER BY pos) * 1000) AS BIGINT) AS end_ms,
       trim(regexp_replace(string_agg(word, ' ' ORDER BY pos), '\\s+([,.!?])', '\\1', 'g')) AS text FROM wi GROUP BY align_id, sid HAVING bool_or(b))"""
_CHUNKS = f"""{_SENTENCES},
ck(align_id, sentence_no, chunk_no, cs, ce, text) AS (
  SELECT align_id, sentence_no, 0, start_ms, end_ms, text FROM st WHERE sentence_no = 0
  UNION ALL
  SELECT s.align_id, s.sentence_no, CASE WHEN t THEN c.chunk_no ELSE c.chunk_no + 1 END, CASE WHEN t THEN c.cs ELSE s.start_ms END, s.end_ms,
         CASE WHEN t THEN c.text || ' ' || s.text ELSE s.text END
  FROM (SELECT c.*, NOT ((c.ce - c.cs) / 1000.0 >= 15 AND (c.ce - c.cs) / 1000.0 >= 1) AND (c.ce = c.cs OR (n.end_ms - c.cs) / 1000.0 <= 30) AS t
        FROM ck c JOIN st n ON n.align_id = c.align_id AND n.sentence_no = c.sentence_no + 1) c
  JOIN st s ON s.align_id = c.align_id AND s.sentence_no = c.sentence_no + 1),
cf AS (SELECT align_id, chunk_no, max(cs) AS start_ms, last(ce ORDER BY sentence_no) AS end_ms, last(text ORDER BY sentence_no) AS text FROM ck GROUP BY align_id, chunk_no)"""


# Curation ----------------------------------------------------------------------------------------------------------


def drop_bad_language(spark: SparkSession, d: str) -> DataFrame:
    verdicts = _scripts(spark, d).select("dir", "base", curate.bad_language(F.col("language"), WANTED_LANGUAGE).alias("bad"))
    verdicts = verdicts.groupBy("dir", "base").agg(F.lit(True).alias("valid"), F.bool_or("bad").alias("bad"))
    moves = curate.language_moves(_catalog(spark, d), verdicts)
    return curate.manifest(moves, "path", F.col("moves"), "/out").select("src", "action", "dst")


def drop_numbers(spark: SparkSession, d: str) -> DataFrame:
    flagged = _labels(spark, d).filter(text.has_digit(F.col("text")))
    return curate.siblings(_catalog(spark, d), flagged, ["dir", "base"]).select("path")


def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = curate.keep_first(table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id")
    return rows.filter("text IS NOT NULL").select("doc_id", "is_first", F.col("copies").cast("bigint").alias("copies"))


def pending_work(spark: SparkSession, d: str) -> DataFrame:
    return curate.pending(_labels(spark, d), _scripts(spark, d), ["dir", "base"]).select("label_id", "path")


def priority_sibling(spark: SparkSession, d: str) -> DataFrame:
    return curate.first_by_priority(_catalog(spark, d), ["dir", "base"], "ext", ["json", "txt"]).select("dir", "base", "ext", "path")


def metadata_manifest(spark: SparkSession, d: str) -> DataFrame:
    audio = _scripts(spark, d).select("dir", "base", F.col("path").alias("audio_path"))
    return _labels(spark, d).filter("text IS NOT NULL").join(audio, ["dir", "base"]).select("audio_path", text.one_line(F.col("text")).alias("text"))


def language_partition(spark: SparkSession, d: str) -> DataFrame:
    lang = F.coalesce(F.col("language"), F.lit("unknown"))
    return _scripts(spark, d).select("transcript_id", lang.alias("lang"), F.concat_ws("/", F.lit("/out"), lang, F.concat_ws(".", F.col("base"), F.col("ext"))).alias("dst"))


def sentence_rule_violations(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d).select("label_id", F.explode(text.rule_violations(F.col("text"))).alias("rule")).groupBy("rule").agg(F.count("*").alias("labels"))


def stable_rename(spark: SparkSession, d: str) -> DataFrame:
    name = curate.random_name(F.concat_ws("/", "dir", "base"), "7")
    return _catalog(spark, d).select("path", F.concat_ws("_", name, F.col("base")).alias("new_base"), F.count("*").over(_by("dir", "base", "ext")).alias("same_target"))


def _by(*keys: str):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


def rename_collisions(spark: SparkSession, d: str) -> DataFrame:
    return _catalog(spark, d).groupBy("base").agg(F.countDistinct("dir").alias("dirs"), F.count("*").alias("files")).filter("dirs > 1")


def json_merge(spark: SparkSession, d: str) -> DataFrame:
    merged = _labels(spark, d).join(_scripts(spark, d).select("dir", "base", F.col("path").alias("json_path"), "segments"), ["dir", "base"])
    return merged.select("label_id", "json_path", F.col("text").alias("sentence"), F.size(F.coalesce("segments", F.array().cast("array<struct<text:string>>"))).alias("n_segments"))


def group_presence(spark: SparkSession, d: str) -> DataFrame:
    has = lambda e: F.bool_or(F.col("ext") == e).alias(f"has_{e}")
    return _catalog(spark, d).groupBy("dir", "base").agg(has("json"), has("txt"))


def labels_beside_transcripts(spark: SparkSession, d: str) -> DataFrame:
    return curate.with_texts(_labels(spark, d).select("label_id", "dir", "base"), _scripts(spark, d), ["dir", "base"]).select("label_id", "text_path", "warning")


def mirrored_paths(spark: SparkSession, d: str) -> DataFrame:
    return curate.with_existing(_scripts(spark, d).select("transcript_id", "path"), "path", table(spark, d, "transcripts_mirror")).select("transcript_id", "path")


def flat_moves(spark: SparkSession, d: str) -> DataFrame:
    return curate.manifest(_catalog(spark, d), "path", F.col("ext") == "json", "/flat", keep_tree=False)


# Profiles ----------------------------------------------------------------------------------------------------------


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return profile.word_counts(_docs(spark, d), "text")


def word_totals(spark: SparkSession, d: str) -> DataFrame:
    return profile.word_totals(word_counts(spark, d))


def word_freq_of_freq(spark: SparkSession, d: str) -> DataFrame:
    return profile.frequency_of_frequencies(word_counts(spark, d))


def letter_frequency(spark: SparkSession, d: str) -> DataFrame:
    return profile.letter_frequency(_docs(spark, d), "text").select("letter", "n")


def token_totals(spark: SparkSession, d: str) -> DataFrame:
    return profile.token_totals(_docs(spark, d), "text")


def duration_totals(spark: SparkSession, d: str) -> DataFrame:
    return profile.duration_totals(table(spark, d, "events"), "value")


def duration_stats(spark: SparkSession, d: str) -> DataFrame:
    return profile.duration_stats(table(spark, d, "events"), "value")


def duration_histogram(spark: SparkSession, d: str) -> DataFrame:
    return profile.histogram(table(spark, d, "events"), "value")


def duration_kde(spark: SparkSession, d: str) -> DataFrame:
    return profile.density(table(spark, d, "events"), "value")


_WC = rf"""wd AS (SELECT unnest(string_split_regex(translate(lower(text), '{text.PUNCTUATION.replace("'", "''")}', ''), '{_SP}+')) AS word FROM documents WHERE text IS NOT NULL),
wc AS (SELECT word, count(*) AS n FROM wd WHERE word <> '' GROUP BY word)"""
_KEPT = "k AS (SELECT value AS x FROM events WHERE value <= 30), r AS (SELECT min(x) AS lo, max(x) AS hi, stddev_samp(x) * pow(count(*), -0.2) AS h, count(*) AS n FROM k)"


# Signals -----------------------------------------------------------------------------------------------------------


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings")


def noise_floor(spark: SparkSession, d: str) -> DataFrame:
    return _vectors(spark, d).select("vec_id", F.round(signal.worst_of_two(F.col("embedding"), 32, 8, 8), 6).alias("noise_db"))


def noise_top5(spark: SparkSession, d: str) -> DataFrame:
    return noise_floor(spark, d).orderBy(F.col("noise_db").desc(), "vec_id").limit(5)


def noise_summary(spark: SparkSession, d: str) -> DataFrame:
    return noise_floor(spark, d).agg(F.round(F.avg("noise_db"), 4).alias("mean_db"), F.min("noise_db").alias("best_db"), F.max("noise_db").alias("worst_db"))


def band_energy(spark: SparkSession, d: str) -> DataFrame:
    return signal.band_energy(_vectors(spark, d), "vec_id", "embedding", 17.0)


def filter_energy_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Energy of each vector before and behind a filter that takes away the low hum, and which are above the most."""
    bands = band_energy(spark, d).groupBy("vec_id").agg(F.sum("energy").alias("unfiltered"), F.sum(F.when(F.col("label") != "low_hum", F.col("energy"))).alias("filtered"))
    ratio = signal.energy_ratio(F.col("unfiltered"), F.col("filtered"))
    return bands.select("vec_id", F.round(ratio, 6).alias("ratio"), signal.above(F.round(ratio, 6)).alias("moves"))


def class_top5(spark: SparkSession, d: str) -> DataFrame:
    names = spark.createDataFrame([(k, f"class {k}") for k in range(0, 64, 2)], "class int, name string")
    top = signal.top_classes(signal.class_means(_vectors(spark, d), "label", "embedding"), "label")
    return top.join(names, "class", "left").select("label", "rank", "class", F.coalesce("name", F.lit("unknown")).alias("name"), "score")


def speech_gate(spark: SparkSession, d: str) -> DataFrame:
    """The first two members of a vector as the scores of two classes; the second one is speech but for one label."""
    score = lambda name, k: F.struct(name.alias("label"), F.get(F.col("embedding"), k).cast("double").alias("score"))
    second = F.when(F.col("label") != 3, F.lit("Speech")).otherwise(F.lit("Noise"))
    scores = F.array(score(F.lit("Music"), 0), score(second, 1))
    return _vectors(spark, d).select("vec_id", curate.low_score(scores, least=0.1).alias("moves"))


def long_media_parts(spark: SparkSession, d: str) -> DataFrame:
    return signal.media_parts(table(spark, d, "events"), "event_id", "value", 100.0).withColumns({"from_s": F.round("from_s", 3), "to_s": F.round("to_s", 3)})


def progress_eta(spark: SparkSession, d: str) -> DataFrame:
    return progress.estimated(table(spark, d, "events"), "user_id", "event_id", "ts")


def outcome_counts(spark: SparkSession, d: str) -> DataFrame:
    return progress.outcomes(table(spark, d, "events"), "event_type")


def realtime_factor(spark: SparkSession, d: str) -> DataFrame:
    """Media seconds of each event for each second since the user's event before; a first event has no factor."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    spent = (at - F.lag(at).over(_by("user_id").orderBy("ts", "event_id"))) / F.lit(1e6)
    rows = table(spark, d, "events").select("event_id", "value", spent.alias("spent"))
    return rows.select("event_id", F.when(F.col("spent").isNotNull(), F.round(progress.realtime_factor(F.col("value"), F.col("spent")), 6)).alias("factor"))


_PADDED = lambda a: f"list_concat(list_concat([0.0, 0.0, 0.0, 0.0], {a}), [0.0, 0.0, 0.0, 0.0])"
_RMS = lambda a: f"[sqrt(list_sum([pow(CAST(x AS DOUBLE), 2) for x in {_PADDED(a)}[i * 8 + 1 : i * 8 + 8]]) / 8) for i in range(5)]"
_P10 = lambda a: f"20 * log10(quantile_cont_list + 1e-6)".replace("quantile_cont_list", f"list_aggregate({_RMS(a)}, 'quantile_cont', 0.1)")  # noqa: E731,F541
_NOISE = f"nf AS (SELECT vec_id, round(greatest({_P10('embedding[1:32]')}, {_P10('embedding[33:64]')}), 6) AS noise_db FROM embeddings)"
_BANDS_SQL = f"""WITH x AS (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings), e AS (SELECT vec_id, i * 17.0 AS f, pow(CAST(v AS DOUBLE), 2) AS e FROM x),
b(label, low, high) AS (VALUES {', '.join(f"('{k}', {a}, {z})" for k, (a, z) in signal.BANDS.items())}), t AS (SELECT vec_id, sum(e) AS total FROM e GROUP BY vec_id)
SELECT t.vec_id, label, CAST(low AS INTEGER) AS low, CAST(high AS INTEGER) AS high, round(coalesce(sum(e.e), 0), 6) AS energy, round(CASE WHEN total > 0 THEN coalesce(sum(e.e), 0) / total ELSE 0 END, 6) AS ratio
FROM t CROSS JOIN b LEFT JOIN e ON e.vec_id = t.vec_id AND e.f BETWEEN low AND high GROUP BY t.vec_id, label, low, high, total"""
_STAMP = "PARTITION BY user_id ORDER BY ts, event_id"

QUERIES = {
    f.__name__: f
    for f in (
        transcript_agreement_by_lang, fuzzy_agreement_by_lang, transcript_agreement_totals, drop_unmatched_groups, fuzzy_unmatched_groups, sentence_segments, greedy_chunks, legacy_sentences, short_chunk_stats,
        drop_bad_language, drop_numbers, exact_dedup, pending_work, priority_sibling, metadata_manifest, language_partition, sentence_rule_violations,
        stable_rename, rename_collisions, json_merge, group_presence, labels_beside_transcripts, mirrored_paths, flat_moves, word_counts, word_totals, word_freq_of_freq, letter_frequency, token_totals,
        duration_totals, duration_stats, duration_histogram, duration_kde, noise_floor, noise_top5, noise_summary, band_energy, filter_energy_ratio, class_top5, speech_gate,
        long_media_parts, progress_eta, outcome_counts, realtime_factor,
    )
}

SQL = {
    "transcript_agreement_by_lang": _BY_LANG(_MATCHED),
    "fuzzy_agreement_by_lang": _BY_LANG(_FUZZY),
    "fuzzy_unmatched_groups": f"WITH {_FUZZY} SELECT label_id, transcript_id, count(*) AS lines FROM mt GROUP BY ALL HAVING count_if(is_norm) = 0",
    "transcript_agreement_totals": f"WITH {_MATCHED} SELECT count(DISTINCT (label_id, transcript_id)) AS groups, count(*) AS lines, CAST(count_if(is_exact) AS BIGINT) AS exact, CAST(count_if(is_norm) AS BIGINT) AS normalized FROM mt",
    "drop_unmatched_groups": f"WITH {_MATCHED} SELECT label_id, transcript_id, count(*) AS lines FROM mt GROUP BY ALL HAVING count_if(is_norm) = 0",
    "sentence_segments": f"WITH {_SENTENCES} SELECT * FROM st",
    "greedy_chunks": f"WITH RECURSIVE {_CHUNKS} SELECT align_id, chunk_no, start_ms, end_ms, text FROM cf",
    "short_chunk_stats": f"WITH RECURSIVE {_CHUNKS} SELECT CASE WHEN start_ms >= end_ms THEN 'invalid' WHEN end_ms - start_ms < 200 THEN 'short' ELSE 'kept' END AS status, count(*) AS chunks FROM cf GROUP BY 1",
    "legacy_sentences": f"""WITH {_WORDS},
u1 AS (SELECT *, regexp_matches(word, '^\\p{{Lu}}') AS up, min(CASE WHEN regexp_matches(word, '^\\p{{Lu}}') THEN pos END) OVER (PARTITION BY align_id) AS f FROM w),
u2 AS (SELECT *, CASE WHEN up AND regexp_matches(lag(word) OVER (PARTITION BY align_id ORDER BY pos), '[.!?]$') THEN 1 ELSE 0 END AS b FROM u1 WHERE pos >= f),
u3 AS (SELECT *, sum(b) OVER (PARTITION BY align_id ORDER BY pos) AS sid FROM u2),
u4 AS (SELECT align_id, CAST(sid AS INTEGER) AS sentence_no, arg_min(struct_pack(v := s), pos).v AS s, arg_max(struct_pack(v := e), pos).v AS e, string_agg(word, ' ' ORDER BY pos) AS t FROM u3 GROUP BY align_id, sid)
SELECT align_id, sentence_no, CAST(trunc(s * 1000) AS BIGINT) AS start_ms, CAST(trunc(e * 1000) AS BIGINT) AS end_ms, regexp_replace(t, '\\s([,.!?])', '\\1', 'g') AS text,
CASE WHEN s IS NULL THEN 'start_missing' WHEN e IS NULL THEN 'end_missing' WHEN CAST(trunc(e * 1000) AS BIGINT) - CAST(trunc(s * 1000) AS BIGINT) < 500 THEN 'short' ELSE 'kept' END AS status FROM u4""",
    "drop_bad_language": f"""WITH {_CATALOG}, v AS (SELECT dir, base, bool_or(coalesce(language, '') <> '{WANTED_LANGUAGE}') AS bad FROM scr GROUP BY ALL),
m AS (SELECT c.path, CASE WHEN c.ext = 'json' THEN coalesce(v.bad, false) ELSE v.base IS NULL OR v.bad END AS mv FROM cat c LEFT JOIN v ON c.dir = v.dir AND c.base = v.base)
SELECT path AS src, CASE WHEN mv THEN 'move' ELSE 'keep' END AS action, CASE WHEN mv THEN '/out/' || regexp_replace({_P('path')}, '^/', '') END AS dst FROM m""",
    "drop_numbers": f"WITH {_CATALOG} SELECT path FROM cat WHERE (dir, base) IN (SELECT (dir, base) FROM lab WHERE regexp_matches(text, '\\p{{Nd}}'))",
    "exact_dedup": "SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY text) AS is_first, count(*) OVER (PARTITION BY text) AS copies FROM documents WHERE text IS NOT NULL",
    "pending_work": f"WITH {_LABELS}, {_SCRIPTS} SELECT label_id, path FROM lab WHERE NOT EXISTS (SELECT 1 FROM scr WHERE scr.dir = lab.dir AND scr.base = lab.base)",
    "priority_sibling": f"WITH {_CATALOG}, k AS (SELECT *, row_number() OVER (PARTITION BY dir, base ORDER BY CASE ext WHEN 'json' THEN 1 ELSE 2 END, path) AS rn FROM cat WHERE ext IN ('json', 'txt')) SELECT dir, base, ext, path FROM k WHERE rn = 1",
    "metadata_manifest": f"WITH {_LABELS}, {_SCRIPTS} SELECT scr.path AS audio_path, {_STRIP("replace(text, chr(10), ' ')")} AS text FROM lab JOIN scr USING (dir, base) WHERE text IS NOT NULL",
    "language_partition": f"WITH {_SCRIPTS} SELECT transcript_id, coalesce(language, 'unknown') AS lang, '/out/' || coalesce(language, 'unknown') || '/' || base || '.' || ext AS dst FROM scr",
    "sentence_rule_violations": f"""WITH {_LABELS}, t AS (SELECT {_STRIP("coalesce(text, '')")} AS t FROM lab),
v AS (SELECT unnest(CASE WHEN t = '' THEN ['empty'] ELSE list_filter([CASE WHEN NOT regexp_matches(t, '^\\p{{Lu}}') THEN 'not_upper' END, CASE WHEN NOT regexp_matches(t, '[.!?]$') THEN 'no_end' END], lambda x: x IS NOT NULL) END) AS rule FROM t)
SELECT rule, count(*) AS labels FROM v GROUP BY rule""",
    "stable_rename": f"WITH {_CATALOG} SELECT path, substr(sha256('7|' || dir || '/' || base), 1, 20) || '_' || base AS new_base, count(*) OVER (PARTITION BY dir, base, ext) AS same_target FROM cat",
    "rename_collisions": f"WITH {_CATALOG} SELECT base, count(DISTINCT dir) AS dirs, count(*) AS files FROM cat GROUP BY base HAVING count(DISTINCT dir) > 1",
    "json_merge": f"WITH {_LABELS}, {_SCRIPTS} SELECT label_id, scr.path AS json_path, text AS sentence, CAST(coalesce(len(segments), 0) AS INTEGER) AS n_segments FROM lab JOIN scr USING (dir, base)",
    "group_presence": f"WITH {_CATALOG} SELECT dir, base, bool_or(ext = 'json') AS has_json, bool_or(ext = 'txt') AS has_txt FROM cat GROUP BY ALL",
    "labels_beside_transcripts": f"WITH {_LABELS}, {_SCRIPTS}, t AS (SELECT dir, base, min(path) AS text_path FROM scr GROUP BY ALL) SELECT label_id, text_path, CASE WHEN text_path IS NULL THEN 'no text beside it' END AS warning FROM lab LEFT JOIN t USING (dir, base)",
    "mirrored_paths": f"WITH {_SCRIPTS} SELECT transcript_id, path FROM scr WHERE path IN (SELECT path FROM transcripts_mirror WHERE path IS NOT NULL)",
    "flat_moves": f"""WITH {_CATALOG}, f AS (SELECT path AS src, CASE WHEN ext = 'json' THEN 'move' ELSE 'keep' END AS action, CASE WHEN ext = 'json' THEN '/flat/' || regexp_extract({_P('path')}, '([^/]*)$', 1) END AS dst FROM cat),
c AS (SELECT *, count(*) OVER (PARTITION BY dst) AS n FROM f) SELECT src, action, dst, CASE WHEN dst IS NOT NULL AND n > 1 THEN n ELSE 0 END AS collides FROM c""",
    "word_counts": f"WITH {_WC} SELECT word, n FROM wc",
    "word_totals": f"WITH {_WC} SELECT CAST(sum(n) AS BIGINT) AS total_words, count(*) AS unique_words FROM wc",
    "word_freq_of_freq": f"WITH {_WC}, o AS (SELECT CASE WHEN n <= 10 THEN CAST(n AS VARCHAR) ELSE '>10' END AS k FROM wc) SELECT e.k AS occurrences, count(o.k) AS words FROM (SELECT unnest(['1','2','3','4','5','6','7','8','9','10','>10']) AS k) e LEFT JOIN o ON e.k = o.k GROUP BY e.k",
    "letter_frequency": f"WITH l AS (SELECT unnest(regexp_extract_all(lower(text), '({text.LETTER})')) AS letter FROM documents), a AS (SELECT unnest({text.HUNGARIAN}) AS letter) SELECT a.letter, count(l.letter) AS n FROM a LEFT JOIN l ON a.letter = l.letter GROUP BY a.letter",
    "token_totals": "WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{N}_]+)')) AS t FROM documents) SELECT count(*) AS total_tokens, count(DISTINCT t) AS unique_tokens FROM t",
    "duration_totals": "WITH s AS (SELECT round(sum(coalesce(value, 0)), 3) AS total, round(sum(CASE WHEN value > 30 THEN value ELSE 0 END), 3) AS long_total, CAST(count_if(value > 30) AS BIGINT) AS long_items FROM events) SELECT *, format('{}h {}m {}s', CAST(floor(total) AS BIGINT) // 3600, CAST(floor(total) AS BIGINT) % 3600 // 60, CAST(floor(total) AS BIGINT) % 60) AS total_text FROM s",
    "duration_stats": "SELECT min(value) AS shortest, max(value) AS longest, round(avg(value), 6) AS mean, count(value) AS readable, CAST(count_if(value > 30) AS BIGINT) AS excluded FROM events WHERE value IS NOT NULL",
    "duration_histogram": f"WITH {_KEPT}, b AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin FROM k, r) SELECT CAST(g AS INTEGER) AS bin, count(b.bin) AS n FROM range(30) t(g) LEFT JOIN b ON b.bin = g GROUP BY g",
    "duration_kde": f"WITH {_KEPT} SELECT CAST(g AS INTEGER) AS point, round(any_value(lo + g * (hi - lo) / 199), 6) AS at, round(sum(exp(-0.5 * pow((lo + g * (hi - lo) / 199 - x) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 6) AS density FROM k, r, range(200) t(g) GROUP BY g",
    "noise_floor": f"WITH {_NOISE} SELECT * FROM nf",
    "noise_top5": f"WITH {_NOISE} SELECT * FROM nf ORDER BY noise_db DESC, vec_id LIMIT 5",
    "noise_summary": f"WITH {_NOISE} SELECT round(avg(noise_db), 4) AS mean_db, min(noise_db) AS best_db, max(noise_db) AS worst_db FROM nf",
    "band_energy": _BANDS_SQL,
    "filter_energy_ratio": f"WITH be AS ({_BANDS_SQL}), r AS (SELECT vec_id, round(sum(energy) / nullif(greatest(sum(CASE WHEN label <> 'low_hum' THEN energy END), 0), 0), 6) AS ratio FROM be GROUP BY vec_id) SELECT vec_id, ratio, coalesce(ratio > 1.1, false) AS moves FROM r",
    "class_top5": "WITH x AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS class FROM embeddings), m AS (SELECT label, class, round(avg(v), 6) AS score FROM x GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, class) AS rank FROM m) SELECT label, CAST(rank AS INTEGER) AS rank, CAST(class AS INTEGER) AS class, CASE WHEN class % 2 = 0 THEN 'class ' || class ELSE 'unknown' END AS name, score FROM k WHERE rank <= 5",
    "speech_gate": "SELECT vec_id, CASE WHEN label <> 3 THEN coalesce(CAST(embedding[2] AS DOUBLE) < 0.1, true) ELSE true END AS moves FROM embeddings",
    "long_media_parts": "WITH e AS (SELECT event_id, value, unnest(range(1, CAST(ceil(value / 100) AS BIGINT) + 1)) AS k FROM events WHERE value > 100) SELECT event_id, CAST(k AS INTEGER) AS part, CAST(100 * (k - 1) AS DOUBLE) AS from_s, round(least(100.0 * k, value), 3) AS to_s FROM e",
    "progress_eta": f"""WITH p AS (SELECT user_id, event_id, row_number() OVER ({_STAMP}) AS done, count(*) OVER (PARTITION BY user_id) AS total, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id) AS us FROM events)
SELECT user_id, event_id, CAST(done AS INTEGER) AS done, total, round(100.0::DOUBLE * done / total, 4) AS percent, round(us / 1e6::DOUBLE / done * (total - done), 3) AS eta_s FROM p""",
    "outcome_counts": "SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type",
    "realtime_factor": f"WITH p AS (SELECT event_id, value, (epoch_us(ts) - lag(epoch_us(ts)) OVER ({_STAMP})) / 1e6::DOUBLE AS spent FROM events) SELECT event_id, round(CASE WHEN spent IS NULL THEN NULL WHEN spent > 0 THEN value / spent ELSE 0 END, 6) AS factor FROM p",
}
