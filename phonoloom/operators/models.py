"""Where speech models plug in: one loaded instance for each task, batches through Arrow, an error as a status.

No model is bundled. The ``Stub`` is deterministic and says only what its input's bytes say; it exists for tests and wiring.
"""

from __future__ import annotations

import hashlib
import signal
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Model(Protocol):
    def __call__(self, content: bytes) -> str:
        """JSON of the result for one recording."""


class Stub:
    def __call__(self, content: bytes) -> str:
        return '{"language": "unknown", "segments": [{"text": "%s"}]}' % hashlib.sha256(content).hexdigest()[:12]


class TooLong(Exception):
    pass


def _limited(work: Callable[[], str], seconds: float | None) -> str:
    """Result of ``work``, or ``TooLong`` if it takes more seconds; an alarm of the worker process, whose main thread this is."""
    if not seconds:
        return work()

    def stop(*_) -> None:
        raise TooLong(f"more than {seconds} s")

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        return work()
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def apply_model(df: DataFrame, key: str, content: str, load: Callable[[], Model], attempts: int = 4, seconds: float | None = None) -> DataFrame:
    """``key, status, error, result, attempts``. ``load`` is called once in each task; put anti joins before this, no filter moves
    through it. A recording is tried up to ``attempts`` times, each for at most ``seconds``; the last error stays (``timeout``,
    or ``error``). A null content is an error row without an attempt; lost tasks are run again by Spark."""
    if attempts < 1:
        raise ValueError("at least one attempt")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def one(c) -> tuple[str, str | None, str | None, int]:
            if c is None:
                return "error", "no content", None, 0
            status, error = "error", None
            for n in range(1, attempts + 1):
                try:
                    return "ok", None, _limited(lambda: model(bytes(c)), seconds), n
                except Exception as e:  # noqa: BLE001
                    status, error = ("timeout" if isinstance(e, TooLong) else "error"), f"{type(e).__name__}: {e}"
            return status, error, None, attempts

        for b in batches:
            got = [one(c) for c in b["content"]]
            columns = {n: [g[i] for g in got] for i, n in enumerate(("status", "error", "result", "attempts"))}
            yield pd.DataFrame({"k": b["k"], **columns})

    rows = df.select(F.col(key).cast("string").alias("k"), F.col(content).alias("content"))
    return rows.mapInPandas(run, "k string, status string, error string, result string, attempts int").withColumnRenamed("k", key)


def gpu_settings(per_executor: int = 1, discovery: str | None = None) -> dict[str, str]:
    """Settings of a session that gives each task a device of its own: Spark hands out the devices that the discovery script
    names, one task for each, so a queue for each device, and watching for idle ones, is the scheduler's work."""
    out = {"spark.executor.resource.gpu.amount": str(per_executor), "spark.task.resource.gpu.amount": "1"}
    return out | ({"spark.executor.resource.gpu.discoveryScript": discovery} if discovery else {})


def supervision_settings(attempts: int = 4) -> dict[str, str]:
    """Settings by which lost or hanging tasks are tried again: failures up to ``attempts``, and a second copy of stragglers."""
    return {"spark.task.maxFailures": str(attempts), "spark.speculation": "true", "spark.speculation.quantile": "0.9", "spark.network.timeout": "600s"}
