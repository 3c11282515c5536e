"""Profiles of a corpus: words, letters, tokens, durations, histograms and densities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonoloom.functions import text
from phonoloom.functions.numbers import bin_index, clock


def word_counts(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.explode(text.words(text.bare(F.col(column)))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def word_totals(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_words"), F.count("*").alias("unique_words"))


def frequency_of_frequencies(counts: DataFrame, most: int = 10) -> DataFrame:
    """How many words occur 1, 2, ... ``most`` times and more often, zero-filled."""
    bucket = F.when(F.col("n") <= most, F.col("n").cast("string")).otherwise(F.lit(f">{most}"))
    got = counts.groupBy(bucket.alias("occurrences")).agg(F.count("*").alias("words"))
    every = df_of(counts, [str(i) for i in range(1, most + 1)] + [f">{most}"], "occurrences")
    return every.join(got, "occurrences", "left").fillna(0, ["words"])


def df_of(like: DataFrame, values: list[str], name: str) -> DataFrame:
    """A small dimension of constants."""
    return like.sparkSession.createDataFrame([(v,) for v in values], f"{name} string")


def letter_frequency(df: DataFrame, column: str) -> DataFrame:
    """Counts of the letters of the Hungarian alphabet in its order, zero-filled."""
    got = df.select(F.explode(text.letter_counts_input(F.col(column))).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))
    alphabet = df.sparkSession.createDataFrame(list(enumerate(text.HUNGARIAN)), "position int, letter string")
    return alphabet.join(got, "letter", "left").fillna(0, ["n"]).select("position", "letter", "n").orderBy("position")


def token_totals(df: DataFrame, column: str) -> DataFrame:
    got = df.select(F.explode(text.tokens(F.lower(column))).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    return got.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_tokens"), F.count("*").alias("unique_tokens"))


def duration_totals(df: DataFrame, seconds: str, long: float = 30) -> DataFrame:
    """Total seconds, seconds of items longer than ``long``, both also as text. Unreadable items count as 0."""
    s = F.coalesce(F.col(seconds), F.lit(0.0))
    out = df.agg(F.coalesce(F.sum(s), F.lit(0.0)).alias("total"), F.coalesce(F.sum(F.when(s > long, s)), F.lit(0.0)).alias("long_total"), F.count_if(s > long).alias("long_items"))
    return out.select(F.round("total", 3).alias("total"), F.round("long_total", 3).alias("long_total"), "long_items", clock(F.round("total", 3)).alias("total_text"))


def duration_stats(df: DataFrame, seconds: str, most: float = 30) -> DataFrame:
    """Least, greatest and mean of all readable durations, and how many are above ``most``."""
    return df.filter(F.col(seconds).isNotNull()).agg(
        F.min(seconds).alias("shortest"), F.max(seconds).alias("longest"), F.round(F.avg(seconds), 6).alias("mean"), F.count("*").alias("readable"), F.count_if(F.col(seconds) > most).alias("excluded")
    )


def histogram(df: DataFrame, seconds: str, most: float = 30, bins: int = 30) -> DataFrame:
    """Equal-width bins over the durations up to ``most``, empty bins included; a single value gets half a unit on each side."""
    kept = df.filter(F.col(seconds) <= most).select(F.col(seconds).cast("double").alias("x"))
    low, high = (kept.agg(f("x")).scalar() for f in (F.min, F.max))
    half = F.when(low == high, 0.5).otherwise(0.0)
    got = kept.groupBy(bin_index(F.col("x"), low - half, high + half, bins).alias("bin")).agg(F.count("*").alias("n"))
    return df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(got, "bin", "left").fillna(0, ["n"])


def density(df: DataFrame, seconds: str, most: float = 30, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid, with Scott's bandwidth. Equal values are combined first, and each meets the
    fixed grid inside the row; the sums combine map side."""
    kept = df.filter(F.col(seconds) <= most).select(F.col(seconds).cast("double").alias("x"))
    width = F.stddev_samp("x") * F.power(F.count("*"), F.lit(-0.2))
    low, high, h, n = (kept.agg(e).scalar() for e in (F.min("x"), F.max("x"), width, F.count("*")))
    values = kept.groupBy("x").agg(F.count("*").alias("c")).select("*", low.alias("low"), high.alias("high"), h.alias("h"), n.alias("n"))
    grid = values.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    at = F.col("low") + F.col("point") * (F.col("high") - F.col("low")) / F.lit(points - 1.0)
    kernel = F.col("c") * F.exp(F.lit(-0.5) * F.power((at - F.col("x")) / F.col("h"), F.lit(2.0)))
    whole = F.max(F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    return grid.groupBy("point").agg(F.round(F.max(at), 6).alias("at"), F.round(F.sum(kernel) / whole, 6).alias("density"))
