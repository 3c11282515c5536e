"""Number functions: milliseconds, durations as text, decibels, equal-width bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut_ms(seconds: Column) -> Column:
    """Milliseconds without their fraction; null for NaN and for what is no BIGINT."""
    return F.when(~F.isnan(seconds), (seconds * F.lit(1000.0)).try_cast("bigint"))


def clock(seconds: Column) -> Column:
    """Hours, minutes and seconds as text."""
    s = F.floor(seconds)
    return F.format_string("%dh %dm %ds", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def decibels(x: Column) -> Column:
    return F.lit(20.0) * F.log10(x + F.lit(1e-6))


def bin_index(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Index of an equal-width bin; the last one is closed."""
    return F.least(F.floor((x - low) / ((high - low) / F.lit(bins))), F.lit(bins - 1)).cast("int")


def int_list(c: Column) -> Column:
    """Whole numbers of a comma-separated text; null for pieces that are none."""
    return F.transform(F.split(c, ","), lambda x: F.trim(x).try_cast("int"))


def pcm_scale(c: Column) -> Column:
    """16-bit samples as numbers from -1 to 1."""
    return c / F.lit(32768.0)
