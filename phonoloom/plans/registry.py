"""All queries of the core and their SQL twins, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from phonoloom.plans import corpus, interval_and_diff

MODULES = [corpus, interval_and_diff]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.transcript_agreement_by_lang(spark, sf_dir)
