"""Writers: pipe and comma CSV, JSON lines, single files beside their sources, and the carrying out of manifests.

Single-file writers run on executors, one file for each row, and write to a temporary name first, so a task that is run again
leaves the same files. They and ``apply_manifest`` need a file system that all executors share.
"""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from phonoloom.session import stored


def metadata_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """``audio_path|text`` without a header, quoted only where needed, lines ending in CRLF."""
    out = df.select("audio_path", "text")
    out = out.coalesce(1) if single else out
    out.write.mode("overwrite").options(sep="|", escape='"', lineSep="\r\n", emptyValue="").csv(path)


def noise_csv(df: DataFrame, path: str) -> None:
    df.select("file_path", "noise_level_db").write.mode("overwrite").option("header", "true").csv(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def by_language(df: DataFrame, path: str, language: str = "lang") -> None:
    df.write.mode("overwrite").partitionBy(language).parquet(path)


def dataset(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def json_array(df: DataFrame) -> DataFrame:
    """One row with all rows as a JSON array; for small reports only."""
    return df.agg(F.to_json(F.sort_array(F.collect_list(F.struct(*df.columns)))).alias("json"))


def _write(path: str, content: str | bytes) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.part-{os.getpid()}"
    Path(part).write_bytes(content.encode() if isinstance(content, str) else content)
    os.replace(part, path)


def text_files(df: DataFrame, path: str = "out_path", text: str = "text") -> None:
    """Each row's stripped text and a line end, as a file."""

    def run(rows: Iterator[Row]) -> None:
        for r in rows:
            _write(r[path], (r[text] or "").strip() + "\n")

    df.select(path, text).foreachPartition(run)


def binary_files(df: DataFrame, path: str = "out_path", content: str = "content") -> None:
    """Each row's bytes as a file."""

    def run(rows: Iterator[Row]) -> None:
        for r in rows:
            _write(r[path], bytes(r[content]))

    df.select(path, content).foreachPartition(run)


def json_files(df: DataFrame, path: str = "out_path") -> None:
    """Each row's other columns as an indented JSON file."""
    body = [c for c in df.columns if c != path]

    def run(rows: Iterator[Row]) -> None:
        for r in rows:
            _write(r["p"], json.dumps(json.loads(r["j"]), ensure_ascii=False, indent=4))

    df.select(F.col(path).alias("p"), F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("j")).foreachPartition(run)


def apply_manifest(manifest: DataFrame, copy: bool = False) -> dict[str, int]:
    """Carries out the moves (or copies) of a manifest on the executors; what is done already is skipped. Returns how many were
    ``moved``, ``skipped`` or ``missing``; a task that is run again counts what its first run moved as skipped.

    Colliding destinations are refused before anything moves.
    """
    # Written down first: the catalog behind a manifest changes while files move.
    moves = stored(manifest.filter("action = 'move'").select("src", "dst"))
    if not moves.groupBy("dst").count().filter("count > 1").isEmpty():
        raise ValueError("several files have the same destination")

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"outcome": [_carry(src, dst, copy) for src, dst in zip(b["src"], b["dst"])]})

    # Written before it is counted, so that nothing is carried out twice.
    outcomes = stored(moves.mapInPandas(carry, "outcome string"))
    done = {"moved": 0, "skipped": 0, "missing": 0}
    return done | {r["outcome"]: r["count"] for r in outcomes.groupBy("outcome").count().collect()}


def _carry(src: str, dst: str, copy: bool) -> str:
    if os.path.exists(dst):
        return "skipped"
    if not os.path.exists(src):
        return "missing"
    os.makedirs(os.path.dirname(dst), exist_ok=True)
    part = f"{dst}.part-{os.getpid()}"
    if copy:
        shutil.copy2(src, part)
    else:
        shutil.move(src, part)
    os.replace(part, dst)
    return "moved"
