"""Mixing documents of several sources to target shares of the total size, along a time-varying curriculum.

Each source has a weight over the time t of training, from 0 to 1: share * (1 + tilt * (2 t - 1)). The tilts, weighted by the
shares, sum to zero, so at every time the weights sum to one, and the integral of a source's weight is its share. The documents
of a source stand in a fixed order (the hash of their key); a copy of a document lies at its place in the source's cumulative
tokens, copy after copy of the whole source; the inverse of the cumulative demand of the schedule at that place is the
position of the copy in training, and the mix is range-sorted by position.

The total is the largest at which every source with documents reaches its share within its cap of repeats (or a given
total). Sources without documents cannot contribute: their share goes to the others in proportion, and the report shows it.
With a given total, a source whose cap is too small for its share contributes all it may.

Places come from two-level running sums: over hash ranges of a source, then inside each range, so a source that holds a
third of all rows is never one task's work.

Defined results: source names are compared without case, outer blanks, and with '-' and blanks as '_'. Documents of no listed
source, of a source of weight 0 and without tokens are not chosen. A source listed twice counts once, with summed shares.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phonoloom.llm import tokens
from phonoloom.session import stored

#: How far weights move at most over the time of training, and the bits of a hash range.
STRENGTH, RANGE_BITS = 0.5, 12


def source_name(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(c), r"[\s\-_]+", "_"))


def token_sizes(documents: DataFrame, key: str, text: str, source: str, targets: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, source, tokens`` of the documents of sources with a positive share."""
    wanted = targets.filter("target_share > 0").select(source_name(F.col("source")).alias("source")).distinct()
    rows = documents.filter(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), source_name(F.col(source)).alias("source"), F.col(text).alias("text"))
    rows = rows.join(wanted, "source", "left_semi")
    return tokens.counted(rows, "text", path).select("doc_id", "source", "tokens")


def plan(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """One row per listed source: its pool, share, cap, demand in tokens and tilt. As small as ``targets``."""
    pool = sizes.groupBy("source").agg(F.sum("tokens").alias("pool_tokens"), F.count("*").alias("pool_documents"))
    want = targets.filter(F.col("source").isNotNull()).groupBy(source_name(F.col("source")).alias("source"))
    want = want.agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    t = want.join(pool, "source", "left").fillna(0, ["pool_tokens", "pool_documents"])
    everything = Window.partitionBy(F.lit(1))  # the listed sources only
    able = (F.col("pool_tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    t = t.withColumn("able_share", F.when(able, F.col("target_share")).otherwise(0.0))
    whole = F.sum("able_share").over(everything)
    t = t.withColumn("share", F.when(whole > 0, F.col("able_share") / whole).otherwise(0.0))
    t = t.withColumn("cap_tokens", F.col("pool_tokens") * F.col("max_repeats"))
    largest = F.min(F.when(F.col("share") > 0, F.col("cap_tokens") / F.col("share"))).over(everything)
    t = t.withColumn("total_tokens", F.lit(float(total)) if total is not None else F.coalesce(largest, F.lit(0.0)))
    t = t.withColumn("demand_tokens", F.least(F.col("share") * F.col("total_tokens"), F.col("cap_tokens").cast("double")))
    # Sources that may repeat more are the scarcer ones: they come later in training.
    lean = F.log2(F.greatest("max_repeats", F.lit(1)).cast("double"))
    t = t.withColumn("lean", lean - F.sum(F.col("share") * lean).over(everything))
    most = F.max(F.when(F.col("share") > 0, F.abs("lean"))).over(everything)
    return t.withColumn("tilt", F.when((F.col("share") > 0) & (most > 0), F.lit(STRENGTH) * F.col("lean") / most).otherwise(0.0))


def _places(sizes: DataFrame) -> DataFrame:
    """``before``: tokens of the source's documents before each document, by a two-level running sum."""
    rows = sizes.filter("tokens > 0").withColumn("h", F.xxhash64("doc_id"))
    rows = rows.withColumn("range", F.shiftright(F.col("h"), 64 - RANGE_BITS))
    until = lambda *by: Window.partitionBy(*by[:-1]).orderBy(*by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("source", "range").agg(F.sum("tokens").alias("in_range"))
    ranges = ranges.select("source", "range", F.coalesce(F.sum("in_range").over(until("source", ["range"])), F.lit(0)).alias("base"))
    rows = rows.withColumn("inside", F.coalesce(F.sum("tokens").over(until("source", "range", ["h", "doc_id"])), F.lit(0)))
    return rows.join(ranges, ["source", "range"]).withColumn("before", F.col("base") + F.col("inside"))


def position(done: Column, tilt: Column) -> Column:
    """The time at which a source with this tilt has met the part ``done`` of its demand: the inverse of
    t + tilt * (t * t - t)."""
    rest = 1 - tilt
    root = F.sqrt(rest * rest + 4 * tilt * done)
    return F.when(F.abs(tilt) < 1e-9, done).otherwise(2 * done / (rest + root))


def mixed(sizes: DataFrame, plan_rows: DataFrame) -> DataFrame:
    """``doc_id, source, use_no, tokens, position``, range-sorted by position: one row for each use of a document."""
    p = plan_rows.filter("demand_tokens > 0").select("source", "pool_tokens", "max_repeats", "demand_tokens", "tilt")
    rows = _places(sizes).join(p, "source")
    middle = F.col("before") + F.col("tokens") / 2
    uses = F.least(F.floor((F.col("demand_tokens") - middle) / F.col("pool_tokens")) + 1, F.col("max_repeats").cast("bigint"))
    rows = rows.withColumn("uses", uses.cast("int")).filter("uses > 0")
    rows = rows.select("doc_id", "source", "tokens", "tilt", "demand_tokens", "pool_tokens", middle.alias("middle"), F.explode(F.sequence(F.lit(0), F.col("uses") - 1)).alias("use_no"))
    done = (F.col("use_no") * F.col("pool_tokens") + F.col("middle")) / F.col("demand_tokens")
    rows = rows.withColumn("position", position(done, F.col("tilt")))
    return rows.select("doc_id", "source", "use_no", "tokens", "position").orderBy("position", "source", "doc_id", "use_no")


def shares(mix: DataFrame, plan_rows: DataFrame) -> DataFrame:
    """Target and actual share of each listed source."""
    got = mix.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.countDistinct("doc_id").alias("documents"), F.count("*").alias("uses"), F.max("use_no").alias("last_use"))
    rows = plan_rows.join(got, "source", "left").fillna(0, ["tokens", "documents", "uses"])
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    return rows.select(
        "source", "target_share", "max_repeats", "pool_tokens", "pool_documents", "demand_tokens", "tokens", "documents", "uses",
        F.coalesce(F.col("last_use") + 1, F.lit(0)).alias("most_uses"),
        F.when(whole > 0, F.col("tokens") / whole).otherwise(0.0).alias("actual_share"),
    )


def prepared(documents: DataFrame, targets: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Sizes, written once to the shared folder because the plan and the mix both read them, and the plan."""
    sizes = stored(token_sizes(documents, "doc_id", "text", "source", targets, path))
    return sizes, plan(sizes, targets)
