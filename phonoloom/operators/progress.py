"""Progress of a run, from a log of events: outcomes, speed and the time that is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def realtime_factor(media_seconds: Column, seconds: Column) -> Column:
    """Seconds of media for each second of work; 0 where no time passed."""
    return F.when(seconds > 0, media_seconds / seconds).otherwise(0.0)


def outcomes(log: DataFrame, status: str) -> DataFrame:
    return log.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"))


def estimated(log: DataFrame, run: str, event: str, at: str) -> DataFrame:
    """``run, event, done, total, percent, eta_s`` after each event of a run: mean time per event so far times what remains.

    A run is a work list of one process, so its events are one window; the log has one row per file.
    """
    order = Window.partitionBy(run).orderBy(at, event)
    whole = Window.partitionBy(run)
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    rows = log.select(run, event, F.row_number().over(order).alias("done"), F.count("*").over(whole).alias("total"), ((micros - F.min(micros).over(whole)) / F.lit(1e6)).alias("elapsed"))
    return rows.select(
        run, event, "done", "total", F.round(F.lit(100.0) * F.col("done") / F.col("total"), 4).alias("percent"),
        F.round(F.col("elapsed") / F.col("done") * (F.col("total") - F.col("done")), 3).alias("eta_s"),
    )
