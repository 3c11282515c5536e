"""Filters that decide which files stay, and manifests of what moves where.

Nothing is moved by a query: a manifest lists ``action, src, dst``; ``phonoloom.sinks.writers.apply_manifest`` carries it out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonoloom.functions import paths


def bad_language(language: Column, wanted: str) -> Column:
    """True where the language is not the wanted one; a missing one is not."""
    return F.coalesce(language, F.lit("")) != wanted


def keep_first(df: DataFrame, content: str, order: str) -> DataFrame:
    """``is_first, copies`` of rows of equal content; the first by ``order`` stays. Null contents are no copies.

    Copies are found by a hash first, so only the hash and the key are shuffled; equal hashes of different contents would be
    told apart by the length, which is part of the key.
    """
    key = F.when(F.col(content).isNotNull(), F.concat_ws(":", F.sha2(F.col(content), 256), F.length(content).cast("string")))
    rows = df.withColumn("content_key", F.coalesce(key, F.concat(F.lit("null:"), F.col(order).cast("string"))))
    small = rows.select(F.col(order), "content_key")
    group = small.groupBy("content_key").agg(F.min(order).alias("first"), F.count("*").alias("copies"))
    return rows.join(group, "content_key").withColumn("is_first", F.col(order) == F.col("first")).drop("content_key")


def manifest(files: DataFrame, path: str, flag: Column, target: str, keep_tree: bool = True) -> DataFrame:
    """``src, action, dst`` of each file; ``collides`` counts the files that share a destination."""
    moved = F.coalesce(flag, F.lit(False))
    rows = files.select(F.col(path).alias("src"), F.when(moved, "move").otherwise("keep").alias("action"), F.when(moved, paths.moved(target, F.col(path), keep_tree=keep_tree)).alias("dst"))
    if keep_tree:
        return rows.withColumn("collides", F.lit(0).cast("bigint"))
    many = rows.filter("dst IS NOT NULL").groupBy("dst").agg(F.count("*").alias("n")).filter("n > 1")
    return rows.join(many, "dst", "left").select("src", "action", "dst", F.coalesce("n", F.lit(0)).alias("collides"))


def language_moves(files: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Files (dir, base, ext) that leave with a bad language: the JSON itself if it was judged bad; any other file if its JSON was,
    or if no valid JSON is beside it. ``verdicts`` is ``dir, base, valid, bad`` of the JSON files."""
    joined = files.join(verdicts, ["dir", "base"], "left")
    bad = F.coalesce("bad", F.lit(False)) & F.coalesce("valid", F.lit(False))
    return joined.withColumn("moves", F.when(F.col("ext") == "json", bad).otherwise(bad | ~F.coalesce("valid", F.lit(False))))


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work without a result: a left anti join."""
    return work.join(done.select(*keys), keys, "left_anti")


def first_by_priority(files: DataFrame, keys: list[str], ext: str, order: list[str]) -> DataFrame:
    """The file of the first extension in ``order`` of each group."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(ext))
    return files.filter(rank > 0).groupBy(*keys).agg(F.min_by(F.struct("*"), F.struct(rank, F.col("path"))).alias("f")).select("f.*")


def siblings(files: DataFrame, flagged: DataFrame, keys: list[str]) -> DataFrame:
    """Every file of a flagged group."""
    return files.join(flagged.select(*keys).distinct(), keys, "left_semi")


def random_name(path: Column, seed: str = "0", length: int = 20) -> Column:
    """A name that depends on the path and a seed only."""
    return F.substring(F.sha2(F.concat(F.lit(seed + "|"), path), 256), 1, length)


def low_score(scores: Column, label: str = "Speech", least: float = 0.95) -> Column:
    """True where the first score of a label is missing or below the least."""
    score = F.get(F.filter(scores, lambda s: s["label"] == label), 0)["score"]
    return score.isNull() | (score < least)


def conversion(rate: Column, width: Column, channels: Column, to: tuple[int, int, int] = (24_000, 2, 1)) -> Column:
    return F.when((rate == to[0]) & (width == to[1]) & (channels == to[2]), "copy").otherwise("convert")


def with_texts(copies: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """Copies beside their texts (``text_path``); a copy without one stays, with ``warning``."""
    found = texts.groupBy(*keys).agg(F.min("path").alias("text_path"))
    rows = copies.join(found, keys, "left")
    return rows.withColumn("warning", F.when(F.col("text_path").isNull(), "no text beside it"))


def with_existing(rows: DataFrame, path: str, files: DataFrame) -> DataFrame:
    """Rows whose path is that of an existing file."""
    return rows.join(files.select(F.col("path").alias(path)).distinct(), path, "left_semi")


def merged_samples(jsons: DataFrame, texts: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``path, sentence, analysis`` of each JSON file (path, analysis) with a text (text) beside it, and the paths of those without."""
    one = texts.groupBy(*keys).agg(F.min_by("text", "path").alias("sentence"))
    return jsons.join(one, keys).select("path", "sentence", "analysis"), jsons.join(one, keys, "left_anti").select("path")
