"""Whole runs over a tree of files, from the scan to the files written, each as one plan.

Every run returns DataFrames of what it did (counts, reports, manifests); their files are written when the run is called. Contents
are read on the executors that work on them, and every writer leaves the same files if a task is run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phonoloom.functions import paths
from phonoloom.operators import agreement, curate, signal, transcript
from phonoloom.session import stored
from phonoloom.sinks import writers
from phonoloom.sources import catalog

KEYS = ["dir", "base"]


def _content(spark: SparkSession, root: str) -> DataFrame:
    """``path, content`` of all files; a filter on the path keeps others from being read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return rows.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "content")


def _placed(rows: DataFrame, root: str) -> DataFrame:
    """Adds the place of each path below ``root``: ``dir, base, ext``."""
    top = "/" + root.replace("file:", "").strip("/")
    return rows.withColumn("_rel", F.substring(F.col("path"), len(top) + 2, 1 << 30)).select("*", *paths.parts(F.col("_rel"))).drop("_rel")


def _joined(root: str, *parts: Column | str) -> Column:
    """Parts of a path below ``root``; empty ones are left out."""
    some = [F.lit(root), *(F.when(F.col(p) != "", F.col(p)) if isinstance(p, str) else p for p in parts)]
    return F.concat_ws("/", *some)


def split_recordings(
    spark: SparkSession, root: str, out: str, least: float = 1.0, most: float = 30.0, mean: float = 15.0, spread: float = 5.0,
    uniform: bool = False, start_seconds: float = 0.0, seed: int = 0,
) -> DataFrame:
    """Cuts recordings with word-timed JSON beside them into chunks of sentences, each a WAV and a text file below ``out``.

    Returns one row for each JSON file: ``path, problem, chunks, kept, short, invalid, errors``. Problems: ``invalid json``,
    ``no word_segments``, ``empty word_segments``, ``no recording``, ``no sentence``.
    """
    files = catalog.files(spark, root)
    media = curate.first_by_priority(files.select("path", *KEYS, "ext"), KEYS, "ext", paths.extensions("split")).select(*KEYS, F.col("path").alias("media"), F.col("ext").alias("media_ext"))
    jsons = _placed(catalog.json_files(spark, root, catalog.ALIGNED), root).join(media, KEYS, "left")
    made = transcript.with_sentences(jsons, "word_segments").withColumn("sentences", transcript.from_start(F.col("sentences"), start_seconds))
    problem = (
        F.when(~F.col("valid"), "invalid json")
        .when(F.col("word_segments").isNull(), "no word_segments")
        .when(F.size("word_segments") == 0, "empty word_segments")
        .when(F.col("media").isNull(), "no recording")
        .when(F.size("sentences") == 0, "no sentence")
    )
    made = made.withColumn("problem", problem)
    goal = transcript.targets(F.concat_ws("/", *KEYS), F.size("sentences"), mean, spread, least, most, uniform, seed)
    ready = made.filter("problem IS NULL").withColumn("goal", goal).withColumn("chunks", transcript.chunks(F.col("sentences"), F.col("goal"), least, most))
    # Few rows that each mean much work: one recording is a task's unit.
    ready = ready.select("path", *KEYS, "media", "media_ext", "chunks").repartition(2 * spark.sparkContext.defaultParallelism, "path")
    name = F.concat(F.col("base"), F.lit("_chunk_"), F.col("no").cast("string"))
    cut = signal.cut_files(ready, "media", "chunks").withColumn("place", _joined(out, "dir", name))
    cut = stored(cut.select("path", "status", "error", "audio", "text", "place", "media_ext"))
    kept = cut.filter("status = 'kept'")
    writers.text_files(kept.select(F.concat("place", F.lit(".txt")).alias("out_path"), "text"))
    writers.binary_files(kept.select(F.concat_ws(".", "place", "media_ext").alias("out_path"), "audio"), "out_path", "audio")
    count = lambda status: F.count_if(F.col("status") == status)
    counts = cut.groupBy("path").agg(F.count("*").alias("chunks"), count("kept").alias("kept"), count("short").alias("short"), count("invalid").alias("invalid"), count("error").alias("errors"))
    return made.select("path", "problem").join(counts, "path", "left").fillna(0, ["chunks", "kept", "short", "invalid", "errors"])


def drop_unmatched(spark: SparkSession, root: str, out: str, most_edits: int = 0, groups: tuple[str, ...] = ("txt", "json", "mp3"), move: bool = True) -> dict[str, DataFrame]:
    """Compares texts with the transcripts beside them, line by line, in groups that have all of the extensions, and moves the
    groups of which no line matches to ``out``, in their tree. Returns ``by_language``, ``totals`` and ``moves``."""
    files = stored(catalog.files(spark, root, list(groups)).select("path", "rel_path", *KEYS, "ext"))
    whole = files.groupBy(*KEYS).agg(F.countDistinct("ext").alias("n")).filter(F.col("n") == len(groups)).select(*KEYS)
    texts = _placed(catalog.texts(spark, root), root).select(*KEYS, "text")
    jsons = _placed(catalog.json_files(spark, root, catalog.TRANSCRIPT), root).filter("valid").select(*KEYS, "language", "segments")
    pairs = whole.join(texts, KEYS).join(jsons, KEYS)
    lines = stored(agreement.matches(agreement.line_pairs(pairs, KEYS, "text", "segments", "language"), most_edits))
    flagged = agreement.unmatched(lines, KEYS)
    moves = curate.siblings(files, flagged, KEYS).select("path", "rel_path")
    moves = stored(moves.select(F.col("path").alias("src"), F.lit("move").alias("action"), F.concat_ws("/", F.lit(out), "rel_path").alias("dst")))
    if move:
        writers.apply_manifest(moves)
    return {"by_language": agreement.by_language(lines), "totals": agreement.totals(lines, KEYS), "moves": moves}


def move_noisy(spark: SparkSession, root: str, out: str, suppress: Callable, most: float = 1.1, length: float = 30.0, seed: int = 0, report: str | None = None) -> DataFrame:
    """Measures how much of the speech band a noise filter takes away, and moves recordings above ``most`` with the text and JSON
    beside them to ``out``, in their tree. Returns ``path, speech_energy_ratio, error`` of every recording that is long enough."""
    files = stored(catalog.files(spark, root).select("path", "rel_path", *KEYS, "ext"))
    media = files.filter(F.col("ext").isin(paths.extensions("spectrum")))
    rows = _content(spark, root).join(media.select("path"), "path", "left_semi")
    ratios = stored(signal.speech_energy_ratios(rows, "path", "content", suppress, length, seed))
    loud = media.join(ratios.filter(signal.above(F.col("speech_energy_ratio"), most)).select("path"), "path", "left_semi")
    beside = curate.siblings(files.filter(F.col("ext").isin("txt", "json")), loud, KEYS)
    moves = loud.select("path", "rel_path").unionByName(beside.select("path", "rel_path")).distinct()
    writers.apply_manifest(moves.select(F.col("path").alias("src"), F.lit("move").alias("action"), F.concat_ws("/", F.lit(out), "rel_path").alias("dst")))
    if report:
        writers.json_lines(ratios.select(F.col("path").alias("original_file"), "speech_energy_ratio"), report)
    return ratios


def randomized_copy(spark: SparkSession, root: str, out: str, seed: str = "0") -> DataFrame:
    """Copies recordings under random names, with the texts beside them; what is there already is passed over. Returns
    ``path, out_path, text_path, warning``."""
    files = catalog.files(spark, root)
    media = files.filter(F.col("ext").isin(paths.extensions("random_copy"))).select("path", *KEYS, "ext")
    named = media.withColumn("name", curate.random_name(F.concat_ws("/", *KEYS), seed))
    texts = files.filter("ext = 'txt'").select("path", *KEYS)
    rows = stored(curate.with_texts(named, texts, KEYS).withColumn("out_path", _joined(out, F.concat_ws(".", "name", "ext"))))
    copies = rows.select(F.col("path").alias("src"), F.col("out_path").alias("dst"))
    copies = copies.unionByName(rows.filter("text_path IS NOT NULL").select(F.col("text_path").alias("src"), _joined(out, F.concat("name", F.lit(".txt"))).alias("dst")).distinct())
    writers.apply_manifest(copies.withColumn("action", F.lit("move")), copy=True)
    return rows.select("path", "out_path", "text_path", "warning")


def merge_json_txt(spark: SparkSession, root: str, out: str) -> DataFrame:
    """Writes ``path, sentence, analysis`` of each class-score JSON with a text beside it below ``out``; returns the paths of JSON
    files without one."""
    jsons = _placed(catalog.json_files(spark, root, catalog.SCORES), root).filter("valid")
    texts = _placed(catalog.texts(spark, root), root)
    merged, missing = curate.merged_samples(jsons.select("path", "analysis", *KEYS), texts.select("path", "text", *KEYS), KEYS)
    placed = _placed(merged, root).withColumn("out_path", _joined(out, "dir", F.concat("base", F.lit(".json"))))
    writers.json_files(placed.select("path", "sentence", "analysis", "out_path"))
    return missing


def publishable(spark: SparkSession, root: str, out: str) -> DataFrame:
    """Writes the merged samples whose recording exists as a dataset; returns it."""
    rows = curate.with_existing(_merged(spark, root), "path", catalog.files(spark, root))
    writers.dataset(rows, out)
    return spark.read.schema(rows.schema).parquet(out)


def _merged(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root)
    got = rows.select(F.from_json(F.decode("content", "UTF-8"), catalog.MERGED).alias("j"))
    return got.filter("j.path IS NOT NULL").select("j.path", "j.sentence", "j.analysis")
