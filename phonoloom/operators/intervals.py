"""Overlapping and gapped intervals: continuous periods of each entity, and the gaps between them.

The operator keeps, in keyed state, an ordered map of disjoint intervals for each entity. An insertion finds
what it overlaps by binary search, merges it and updates the neighbouring gaps. Merging is associative, so
the same map works three times:

1. in each input partition, for each (entity, time bucket), over the raw intervals (nothing is shuffled yet; a full
   state is emitted and restarted, which loses nothing);
2. for each (entity, time bucket) after one shuffle of these maps: an entity that holds a third of all
   rows is spread over as many tasks as it has buckets, and a bucket gets one row from each partition;
3. across buckets, where only the latest end of each bucket is carried forward, by a two-level running maximum.

Intervals travel as arrays, one row for each map, and are inserted as sorted runs.

Defined results: an interval with a missing, NaN, infinite or negative start, or an end not after its start,
counts as absent; so does a row whose entity is null. Rows that come twice change nothing. An interval of no
length after rounding is a point that splits a gap. Touching intervals are one period. Empty tables give
empty results; other columns of the input are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phonoloom.session import stored

#: Length of a time bucket, and buckets in a block of the two-level running maximum.
BUCKET_MS, BLOCK = 600_000, 1_024
#: Intervals in the state of an input partition, after which it is emitted and begun anew.
STATE_LIMIT = 200_000


class IntervalMap:
    """Disjoint closed intervals in order; ``gaps[k]`` is the length between intervals k and k + 1."""

    __slots__ = ("starts", "ends", "gaps")

    def __init__(self, starts: list[int] | None = None, ends: list[int] | None = None) -> None:
        self.starts, self.ends = list(starts or ()), list(ends or ())
        self.gaps = [b - a for a, b in zip(self.ends, self.starts[1:])]

    def __len__(self) -> int:
        return len(self.starts)

    def insert(self, start: int, end: int) -> None:
        starts, ends = self.starts, self.ends
        first = bisect_left(ends, start)
        after = bisect_right(starts, end, first)
        if first < after:
            if starts[first] <= start and after == first + 1 and end <= ends[first]:
                return
            start, end = min(start, starts[first]), max(end, ends[after - 1])
        starts[first:after] = [start]
        ends[first:after] = [end]
        new = [start - ends[first - 1]] if first else []
        if first + 1 < len(starts):
            new.append(starts[first + 1] - end)
        self.gaps[max(first - 1, 0) : after] = new

    def insert_run(self, starts: list[int], ends: list[int]) -> None:
        """Inserts disjoint intervals in order: what they reach over is found by binary search and replaced at once."""
        if not starts:
            return
        first = bisect_left(self.ends, starts[0])
        after = bisect_right(self.starts, ends[-1], first)
        if first < after:
            starts, ends = disjoint(sorted([*zip(starts, ends), *zip(self.starts[first:after], self.ends[first:after])]))
        self.starts[first:after] = starts
        self.ends[first:after] = ends
        a, b = max(first - 1, 0), min(first + len(starts), len(self.starts) - 1)
        self.gaps[a:after] = [self.starts[k + 1] - self.ends[k] for k in range(a, b)]

    def periods(self) -> Iterator[tuple[int, int]]:
        return zip(self.starts, self.ends)


def disjoint(rows: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of intervals that are sorted by their starts."""
    starts: list[int] = []
    ends: list[int] = []
    for s, e in rows:
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def seconds_to_ms(seconds: Column) -> Column:
    """Seconds x 1000, rounded to the nearest integer; null where that is no BIGINT."""
    return F.round(seconds * F.lit(1000.0)).try_cast("bigint")


def is_timed(start: Column, end: Column) -> Column:
    """True for numbers with 0 <= start < end; false for null, NaN and infinite values."""
    endless = F.lit(float("inf"))
    return F.coalesce((start >= 0) & (start < end) & (start < endless) & (end < endless), F.lit(False))


def word_intervals(df: DataFrame, key: str, words: str = "word_segments") -> DataFrame:
    """Timed words of ``words`` as rows ``key, start_ms, end_ms``; only those nested columns are read."""
    spans = F.transform(
        F.filter(F.col(words), lambda w: is_timed(w["start"], w["end"])),
        lambda w: F.struct(seconds_to_ms(w["start"]).alias("start_ms"), seconds_to_ms(w["end"]).alias("end_ms")),
    )
    spans = F.filter(spans, lambda s: s["start_ms"].isNotNull() & s["end_ms"].isNotNull())
    return df.filter(F.col(key).isNotNull()).select(F.col(key).alias("entity"), F.inline(spans))


def word_spans(df: DataFrame, key: str, words: str = "word_segments") -> DataFrame:
    """The times of ``words`` as arrays ``entity, start_s, end_s``, one row for each row; only those nested columns are read."""
    return df.filter(F.col(key).isNotNull()).select(F.col(key).alias("entity"), F.col(words)["start"].alias("start_s"), F.col(words)["end"].alias("end_s"))


def _timed_ms(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Milliseconds of the timed ones of pairs of seconds (``is_timed``, ``seconds_to_ms``), and which they are."""
    with np.errstate(invalid="ignore", over="ignore"):
        ok = (starts >= 0) & (starts < ends) & (ends * 1000.0 < 2.0**63)
    at = np.flatnonzero(ok)
    ms = []
    for x in (starts[at] * 1000.0, ends[at] * 1000.0):
        whole = np.floor(x)
        ms.append((whole + (x - whole >= 0.5)).astype(np.int64))
    return ms[0], ms[1], at


def _intervals(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entities, starts and ends in milliseconds of a batch of ``entity, start_ms, end_ms`` or ``entity, start_s, end_s``."""
    entity = batch.column(0).to_numpy(zero_copy_only=False)
    if batch.schema.names[1] == "start_ms":
        return entity, batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
    row = pc.list_parent_indices(batch.column(1)).to_numpy(zero_copy_only=False)
    starts, ends, at = _timed_ms(*(batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (1, 2)))
    return entity[row[at]], starts, ends


_MAPS = [("entity", pa.int64()), ("bucket", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))]


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state: dict[tuple[int, int], IntervalMap] = {}

    def emit() -> pa.RecordBatch:
        rows = [(*key, m.starts, m.ends) for key, m in state.items()]
        state.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _MAPS)], names=[n for n, _ in _MAPS])

    for batch in batches:
        entity, starts, ends = _intervals(batch)
        bucket = starts // BUCKET_MS
        order = np.lexsort((starts, bucket, entity))
        entity, bucket, starts, ends = entity[order], bucket[order], starts[order], ends[order]
        cuts = np.flatnonzero((np.diff(entity) != 0) | (np.diff(bucket) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(entity)]):
            if a == b:
                continue
            reach = np.maximum.accumulate(ends[a:b])
            begins = np.flatnonzero(starts[a + 1 : b] > reach[:-1]) + 1
            key = int(entity[a]), int(bucket[a])
            m = state.get(key)
            if m is None:
                m = state[key] = IntervalMap()
            m.insert_run(starts[a:b][np.r_[0, begins]].tolist(), reach[np.r_[begins - 1, b - a - 1]].tolist())
        if sum(map(len, state.values())) > STATE_LIMIT:
            yield emit()
    if state:
        yield emit()


def _final(least_ms: int | None):
    """Rows come sorted by (entity, bucket): the state of one bucket at a time is alive. Its gaps of at least ``least_ms`` come
    out, or, without that, its intervals."""
    names = ["entity", "bucket", "first_ms", "last_ms", *(("gap_starts", "gap_lengths") if least_ms is not None else ("starts", "ends"))]
    lists = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, m, out = None, IntervalMap(), []

        def close() -> None:
            if key is not None:
                two = (m.starts, m.ends)
                if least_ms is not None:
                    wide = [k for k, g in enumerate(m.gaps) if g >= least_ms]
                    two = [m.ends[k] for k in wide], [m.gaps[k] for k in wide]
                out.append((*key, m.starts[0], m.ends[-1], *two))

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [lists] * 2)], names=names)

        for batch in batches:
            for k, b, starts, ends in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (k, b) != key:
                    close()
                    key, m = (k, b), IntervalMap()
                m.insert_run(starts, ends)
            if out:
                yield made()
                out.clear()
        close()
        if out:
            yield made()

    return run, ", ".join(f"{n} {'array<bigint>' if i > 3 else 'bigint'}" for i, n in enumerate(names))


def _bucketed(intervals: DataFrame, least_ms: int | None = None) -> DataFrame:
    """One row per (entity, bucket): its gaps or its disjoint intervals, and the latest end in the buckets before."""
    columns = ("entity", "start_s", "end_s") if "start_s" in intervals.columns else ("entity", "start_ms", "end_ms")
    rows = intervals.filter(" AND ".join(f"{c} IS NOT NULL" for c in columns)).select(F.col("entity").cast("bigint").alias("entity"), *columns[1:])
    merged = rows.mapInArrow(_partial, "entity bigint, bucket bigint, starts array<bigint>, ends array<bigint>")
    merged = merged.repartition("entity", "bucket").sortWithinPartitions("entity", "bucket")
    # Read three times below: written once, so the state is only built once.
    maps = stored(merged.mapInArrow(*_final(least_ms)))
    tips = maps.select("entity", "bucket", "last_ms", F.floor(F.col("bucket") / F.lit(BLOCK)).cast("bigint").alias("block"))
    before = Window.partitionBy("entity").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("entity", "block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    blocks = tips.groupBy("entity", "block").agg(F.max("last_ms").alias("last_ms"))
    blocks = blocks.select("entity", "block", F.max("last_ms").over(before).alias("block_carry"))
    carried = tips.withColumn("carry", F.max("last_ms").over(inside)).join(blocks, ["entity", "block"])
    carried = carried.select("entity", "bucket", F.greatest("carry", "block_carry").alias("carry"))
    return maps.join(carried, ["entity", "bucket"])


def gaps(intervals: DataFrame, least_ms: int = 0) -> DataFrame:
    """``entity, gap_start_ms, gap_end_ms`` of each uncovered stretch of at least ``least_ms`` (and more than 0)
    between an entity's first start and last end; ``intervals`` is ``entity, start_ms, end_ms`` or the arrays of ``word_spans``.

    The gaps inside a bucket are those that its map kept; what reaches in from earlier buckets shortens them.
    """
    least = max(int(least_ms), 1)
    gap = lambda a, b: F.struct(a.alias("gap_start_ms"), b.alias("gap_end_ms"))
    before = gap(F.col("carry"), F.col("first_ms"))
    kept = F.transform(F.arrays_zip("gap_starts", "gap_lengths"), lambda g: gap(F.greatest(g["gap_starts"], F.col("carry")), g["gap_starts"] + g["gap_lengths"]))
    found = _bucketed(intervals, least).select("entity", F.inline(F.concat(F.array(before), kept)))
    return found.filter(F.col("gap_end_ms") - F.col("gap_start_ms") >= F.lit(least))


def periods(intervals: DataFrame) -> DataFrame:
    """``entity, period_start_ms, period_end_ms``: the continuous periods of each entity.

    A period begins where something starts that nothing before reaches. Its end is the greatest end before the
    next beginning; both come from two-level scans, so a hot entity is never one task's payload.
    """
    maps = _bucketed(intervals)
    rows = maps.select("entity", "bucket", "carry", F.posexplode(F.arrays_zip("starts", "ends")).alias("i", "p"))
    rows = rows.select(
        "entity", "bucket", F.col("p.starts").alias("s"), F.col("p.ends").alias("e"),
        F.greatest(F.lag("p.ends").over(Window.partitionBy("entity", "bucket").orderBy("i")), F.col("carry")).alias("reached"),
    )
    begin = F.col("reached").isNull() | (F.col("s") > F.col("reached"))
    # Runs inside a bucket: cut at each beginning. A run that has no beginning continues an earlier bucket's run.
    run = F.sum(begin.cast("int")).over(Window.partitionBy("entity", "bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, 0))
    runs = rows.withColumn("run", run).groupBy("entity", "bucket", "run").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.bool_or(begin).alias("begins")
    )
    # One row per run is left: number the periods of an entity by counting beginnings, bucket by bucket.
    per = runs.groupBy("entity", "bucket").agg(F.sum(F.col("begins").cast("bigint")).alias("n"))
    per = per.withColumn("block", F.floor(F.col("bucket") / F.lit(BLOCK)).cast("bigint"))
    blocks = per.groupBy("entity", "block").agg(F.sum("n").alias("n"))
    up = lambda *k: Window.partitionBy(*k[:-1]).orderBy(k[-1]).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("entity", "block", F.coalesce(F.sum("n").over(up("entity", "block")), F.lit(0)).alias("b0"))
    per = per.withColumn("n0", F.coalesce(F.sum("n").over(up("entity", "block", "bucket")), F.lit(0)))
    per = per.join(blocks, ["entity", "block"]).select("entity", "bucket", (F.col("n0") + F.col("b0")).alias("n0"))
    numbered = runs.join(per, ["entity", "bucket"]).withColumn("period_no", F.col("n0") + F.col("run") - 1)
    return numbered.groupBy("entity", "period_no").agg(F.min("s").alias("period_start_ms"), F.max("e").alias("period_end_ms"))
