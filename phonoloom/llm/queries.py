"""Queries of the operators on texts, and SQL twins where SQL has the semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phonoloom.llm import forms, langid, lookalike, mixing, pieces, repetition, sentences, subjects, tokens
from phonoloom.session import spread, table


def _words(c: str = "word_segments"):
    return F.transform(F.col(c), lambda w: w["word"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = lookalike.same_look_pairs(table(spark, sf_dir, "text_labels"), "label_id", "text")
    words = lookalike.term_lookalikes(table(spark, sf_dir, "aligned_transcripts"), "align_id", _words(), table(spark, sf_dir, "glossary"), "term")
    return texts.select(F.lit("text").alias("place"), "key_a", "key_b").unionByName(words.select(F.lit("word").alias("place"), "key_a", "key_b"))


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every label whose text comes in other characters too, with its class and its number of links."""
    return lookalike.same_look_classes(table(spark, sf_dir, "text_labels"), "label_id", "text").withColumnRenamed("k", "label_id")


def p4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every label with its text in the consistent form."""
    rows = table(spark, sf_dir, "text_labels").select("label_id", "text").distinct()
    return lookalike.canonical_forms(rows, "text").select("label_id", "canonical")


def p4_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of every aligned row with its consistent form."""
    rows = table(spark, sf_dir, "aligned_transcripts").dropDuplicates(["align_id"])
    rows = rows.select("align_id", F.posexplode(_words()).alias("word_no", "word"))
    return lookalike.canonical_forms(rows, "word").select("align_id", "word_no", "word", "canonical")


def _sentence_model(spark: SparkSession, sf_dir: str) -> sentences.Model:
    return sentences.trained(table(spark, sf_dir, "lang_samples"), table(spark, sf_dir, "subject_samples"))


def _rows_model(spark: SparkSession, sf_dir: str, rows: DataFrame) -> sentences.Model:
    """A model of the clean samples and of all ``rows``, which have ``align_id`` and ``words``."""
    return sentences.trained(table(spark, sf_dir, "lang_samples"), table(spark, sf_dir, "subject_samples"), rows=rows)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "aligned_transcripts").select("align_id", _words().alias("words")))
    return sentences.sentence_units(rows, "align_id", F.col("words"), _rows_model(spark, sf_dir, rows))


def _p3(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, sentences.Model]:
    """The rows, and a model of all of them, also of those within the limit."""
    rows = table(spark, sf_dir, "aligned_transcripts")
    return spread(rows.select("align_id", "word_segments")), _rows_model(spark, sf_dir, spread(rows.select("align_id", _words().alias("words"))))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = _p3(spark, sf_dir)
    return pieces.cut_kinds(rows, "align_id", model)


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = _p3(spark, sf_dir)
    return pieces.pieces(rows, "align_id", model)


def p3_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows over the limit, and breaches of what the pieces promise: the limit, every word in order, the repeated words."""
    words = table(spark, sf_dir, "aligned_transcripts").select("align_id", F.size("word_segments").alias("words")).distinct()
    rows = p3_pieces(spark, sf_dir).join(words, "align_id")
    one = F.col("first_word") == F.col("last_word")
    order = Window.partitionBy("align_id").orderBy("piece_no")
    before = F.lag("last_word").over(order)
    fresh = F.col("first_word") + F.col("repeated_words")
    # Slices of one word share its index.
    follows = F.when(before.isNull(), fresh == 0).otherwise((fresh == before + 1) | (one & (F.col("first_word") == before)))
    rows = rows.withColumns({"follows": follows, "earlier": F.lag(F.col("last_word") - F.col("first_word") + 1).over(order)})
    rows = rows.withColumn("few", F.col("earlier").isNotNull() & (F.col("repeated_words") > F.least(F.lit(pieces.OVERLAP_WORDS), F.col("earlier"))))
    per = rows.groupBy("align_id", "words").agg(
        F.count_if(F.col("end_ms") - F.col("start_ms") > pieces.LIMIT_MS).alias("over"), F.count_if(~F.col("follows")).alias("breaks"),
        F.count_if("few").alias("few"), F.max("last_word").alias("last"),
    )
    return per.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("over"), F.lit(0)).alias("over_limit"), F.coalesce(F.sum("breaks"), F.lit(0)).alias("out_of_order"),
        F.count_if(F.col("last") != F.col("words") - 1).alias("unfinished"), F.coalesce(F.sum("few"), F.lit(0)).alias("overlong_overlaps"),
    )


def _segment_texts():
    return F.transform("segments", lambda s: s["text"])


def _p5(spark: SparkSession, sf_dir: str, found_only: bool) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    documents = repetition.repetition(documents, "doc_id", F.col("text"), found_only)
    scripts = spread(table(spark, sf_dir, "transcripts").select("transcript_id", F.array_join(_segment_texts(), "\n").alias("text")))
    scripts = repetition.repetition(scripts, "transcript_id", F.col("text"), found_only).distinct()
    named = lambda df, place: df.select(F.lit(place).alias("place"), "*")
    return named(documents, "document").unionByName(named(scripts, "transcript"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p5(spark, sf_dir, True).select("place", "item_id")


def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p5(spark, sf_dir, False)


def p6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.trained(table(spark, sf_dir, "lang_samples"), table(spark, sf_dir, "subject_samples"))
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    documents = langid.languages(documents, "doc_id", "lang", F.split("text", "\n"), model)
    scripts = spread(table(spark, sf_dir, "transcripts").select("transcript_id", "language", _segment_texts().alias("texts")))
    scripts = langid.languages(scripts, "transcript_id", "language", F.col("texts"), model).distinct()
    named = lambda df, place: df.select(F.lit(place).alias("place"), "*")
    return named(documents, "document").unionByName(named(scripts, "transcript"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = p6_languages(spark, sf_dir)
    return found.filter((F.col("seg_no") >= 0) | ~F.col("lang").eqNullSafe(F.col("label_lang"))).select("place", "item_id", "seg_no", "lang")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encoded(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text")


def _mixing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixing.prepared(documents, table(spark, sf_dir, "mix_targets"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(*_mixing(spark, sf_dir))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, plan = _mixing(spark, sf_dir)
    return mixing.shares(mixing.mixed(sizes, plan), plan)


def p10_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _sentence_model(spark, sf_dir)
    documents = subjects.split(spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")), "doc_id", "lang", "text", units)
    model = subjects.train(documents, table(spark, sf_dir, "subject_samples"), units)
    return subjects.subject_shares(documents, model)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_subjects(spark, sf_dir).filter(F.col("share") >= subjects.LEAST_SHARE).select("doc_id", "subject")


QUERIES = {
    f.__name__: f
    for f in (
        p2_found, p3_check, p3_found, p3_pieces, p4_classes, p4_found, p4_texts, p4_words, p5_found, p5_shares, p6_found, p6_languages, p8_ids, p9_mix, p9_shares,
        p10_found, p10_subjects,
    )
}

_MAP = {c: forms.ONE_TO_ONE.get(n, n) for c, n in forms.SINGLETONS.items()} | forms.ONE_TO_ONE
_TEXT = lambda t: "'" + t.replace("'", "''") + "'"


def _look(c: str) -> str:
    """The form that texts share if they look the same; composed letters are taken apart before their bases are mapped."""
    for a, b in forms.LIGATURES.items():
        c = f"replace({c}, '{a}', '{b}')"
    return f"nfc_normalize(translate({c}, {_TEXT(''.join(_MAP) + ''.join(map(chr, forms.INVISIBLE)))}, {_TEXT(''.join(_MAP.values()))}))"


_COMPOSED = {"ё": "ë", "Ё": "Ë", "ї": "ï", "Ї": "Ï", "ѐ": "è", "Ѐ": "È"}
_FORM = lambda c: _look(f"translate({c}, '{''.join(_COMPOSED)}', '{''.join(_COMPOSED.values())}')")
_ODDNESS = lambda c: f"len(regexp_extract_all({c}, '{lookalike.ODD}')) + len(regexp_extract_all({c}, '{lookalike.MIXED.replace('Is', '')}'))"
_CORE = f"regexp_replace(word, '^{lookalike.OUTER}+|{lookalike.OUTER}+$', '', 'g')"
SQL = {
    "p4_texts": f"""WITH v AS (SELECT DISTINCT text AS value FROM text_labels WHERE text IS NOT NULL), f AS (SELECT value, {_FORM("value")} AS form, {_ODDNESS("value")} AS odd FROM v),
c AS (SELECT value, first(value) OVER (PARTITION BY form ORDER BY odd, value) AS canonical FROM f)
SELECT label_id, canonical FROM (SELECT DISTINCT label_id, text FROM text_labels) l LEFT JOIN c ON l.text = c.value""",
    "p4_classes": f"""WITH l AS (SELECT DISTINCT label_id, text FROM text_labels WHERE label_id IS NOT NULL AND text IS NOT NULL), f AS (SELECT *, {_FORM("text")} AS form FROM l),
n AS (SELECT *, min(label_id) OVER (PARTITION BY form) AS class_id, count(*) OVER (PARTITION BY form) - count(*) OVER (PARTITION BY text) AS links FROM f)
SELECT label_id, class_id, links FROM n WHERE links > 0""",
    "p4_found": f"""WITH l AS (SELECT DISTINCT label_id, text FROM text_labels WHERE label_id IS NOT NULL AND text IS NOT NULL), f AS (SELECT *, {_FORM("text")} AS form FROM l),
w AS (SELECT DISTINCT align_id, unnest(word_segments).word AS word, unnest(range(len(word_segments))) AS i FROM aligned_transcripts WHERE align_id IS NOT NULL),
k AS (SELECT align_id, i, {_CORE} AS core FROM w), t AS (SELECT DISTINCT term, {_FORM("term")} AS form FROM glossary WHERE term IS NOT NULL)
SELECT DISTINCT 'text' AS place, a.label_id AS key_a, b.label_id AS key_b FROM f a JOIN f b ON a.form = b.form AND a.label_id < b.label_id AND a.text <> b.text
UNION ALL SELECT DISTINCT 'word', align_id, i FROM (SELECT align_id, i, core, {_FORM("core")} AS form FROM k WHERE core <> '') x
WHERE form IN (SELECT form FROM t) AND core NOT IN (SELECT term FROM t)""",
    "p3_check": f"""WITH w AS (SELECT align_id, unnest(word_segments) AS u FROM (SELECT align_id, any_value(word_segments) AS word_segments FROM aligned_transcripts WHERE align_id IS NOT NULL GROUP BY align_id)),
t AS (SELECT align_id, CAST(round(u.start * 1000) AS BIGINT) AS s, CAST(round(u."end" * 1000) AS BIGINT) AS e FROM w WHERE u.start >= 0 AND u."end" > u.start AND isfinite(u.start) AND isfinite(u."end")),
r AS (SELECT align_id FROM t GROUP BY align_id HAVING max(e) - min(s) > {pieces.LIMIT_MS})
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS over_limit, CAST(0 AS BIGINT) AS out_of_order, CAST(0 AS BIGINT) AS unfinished, CAST(0 AS BIGINT) AS overlong_overlaps FROM r""",
}
