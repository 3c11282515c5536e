"""Streams (an extension): progress by time window, and the disjoint intervals of each time bucket in keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from phonoloom.operators.intervals import BUCKET_MS, IntervalMap


def progress_windows(events: DataFrame, at: str = "ts", status: str = "event_type", key: str = "event_id", late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Events by window and status; an event that comes twice within the watermark counts once, later ones are dropped."""
    rows = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark([key])
    return rows.groupBy(F.window(at, window), F.col(status).alias("status")).agg(F.count("*").alias("n")).select("window.start", "window.end", "status", "n")


def _grow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    m = IntervalMap(*state.get) if state.exists else IntervalMap()
    for b in batches:
        for s, e in zip(b["start_ms"].tolist(), b["end_ms"].tolist()):
            m.insert(s, e)
    state.update((m.starts, m.ends))
    yield pd.DataFrame([(key[0], key[1], m.starts, m.ends)], columns=["entity", "bucket", "starts", "ends"])


def growing_periods(intervals: DataFrame) -> DataFrame:
    """The disjoint intervals of each (entity, time bucket) after every batch that adds to it.

    The state is the interval map of one bucket of one entity, so no key's state grows without bound.
    """
    keyed = intervals.withColumn("bucket", F.floor(F.col("start_ms") / F.lit(BUCKET_MS)).cast("bigint"))
    return keyed.groupBy("entity", "bucket").applyInPandasWithState(
        _grow, "entity bigint, bucket bigint, starts array<bigint>, ends array<bigint>", "starts array<bigint>, ends array<bigint>", "update", GroupStateTimeout.NoTimeout
    )
