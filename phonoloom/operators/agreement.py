"""Agreement of a text file's lines with the segments of its transcript, line by line.

Defined results: lines and segments pair by position, the longer side's rest is left out; empty lines count; a missing language
is ``UNKNOWN``; a pair of files without common lines counts as nothing. Null segment texts are empty (a deviation: they would
break the comparison off).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phonoloom.functions.text import lines, normal, strip


def line_pairs(pairs: DataFrame, keys: list[str], text: str, segments: str, language: str) -> DataFrame:
    """``keys, lang, line_no, line, segment``: the zip of a pair's lines and segments, inside the row."""
    # One projection after another: each array is made once.
    rows = pairs.select(*keys, F.coalesce(F.col(language), F.lit("UNKNOWN")).alias("lang"), lines(F.col(text)).alias("a"), F.col(segments).alias("b"))
    rows = rows.withColumn("shared", F.least(F.size("a"), F.size("b"))).filter("shared > 0")
    rows = rows.select(*keys, "lang", F.posexplode(F.arrays_zip(F.slice("a", 1, F.col("shared")).alias("line"), F.slice("b", 1, F.col("shared")).alias("s"))).alias("line_no", "z"))
    return rows.select(*keys, "lang", "line_no", "z.line", strip(F.coalesce(F.col("z.s.text"), F.lit(""))).alias("segment"))


def matches(rows: DataFrame, most_edits: int = 0) -> DataFrame:
    """Adds ``is_exact`` and ``is_norm``: equal, equal in normal form, or at most so many edits of code points apart in normal form.

    The edit distance is only evaluated where the equality tests fail and the lengths allow it, and it gives up beyond the bound.
    """
    rows = rows.withColumns({"_a": normal(F.col("line")), "_b": normal(F.col("segment"))})
    near: Column = F.lit(False)
    if most_edits > 0:
        near = F.when(F.abs(F.length("_a") - F.length("_b")) > most_edits, False).otherwise(F.levenshtein("_a", "_b", most_edits).between(0, most_edits))
    exact = F.col("line") == F.col("segment")
    same = F.when(exact | (F.col("_a") == F.col("_b")), True).otherwise(near)
    return rows.withColumn("is_exact", exact).withColumn("is_norm", same).drop("_a", "_b")


_COUNTS = lambda: (
    F.count("*").alias("lines"), F.count_if("is_exact").alias("exact"), F.count_if("is_norm").alias("normalized"),
)


def by_language(rows: DataFrame) -> DataFrame:
    """Line counts of each language, their parts of the language's own lines, and three distributions: the language's shares of
    all lines without an exact match, of all exact matches and of all normal matches (null where there are none at all).
    Languages come in order of their code."""
    out = rows.groupBy("lang").agg(*_COUNTS())
    everything = Window.partitionBy(F.lit(1))  # one row for each language
    part = lambda n, of: F.lit(100.0) * n / of
    share = lambda c: F.when(F.sum(c).over(everything) > 0, part(c, F.sum(c).over(everything)))
    exact, normal_, missed = F.col("exact"), F.col("normalized"), F.col("lines") - F.col("exact")
    out = out.select(
        "lang", "lines", "exact", "normalized", part(exact, F.col("lines")).alias("exact_pct"), part(normal_, F.col("lines")).alias("normalized_pct"),
        share(missed).alias("unmatched_share"), share(exact).alias("exact_share"), share(normal_).alias("normalized_share"),
    )
    return out.orderBy("lang")


def totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.agg(F.countDistinct(*keys).alias("groups"), *_COUNTS())


def unmatched(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the pairs with lines of which none matches."""
    return rows.groupBy(*keys).agg(F.count("*").alias("lines"), F.count_if("is_norm").alias("normalized")).filter("normalized = 0").select(*keys, "lines")
