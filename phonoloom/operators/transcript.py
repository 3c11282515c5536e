"""Sentences and duration-bounded chunks of word-timed transcripts, inside each row and without a shuffle.

Defined results: a word without a start or an end (null or NaN) has no time. Null and empty arrays give no sentences.
"""

from __future__ import annotations

import math
import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonoloom.functions.numbers import cut_ms
from phonoloom.functions.text import SENTENCE_END, strip, tight

SENTENCE = "struct<start_ms:bigint,end_ms:bigint,text:string>"


def _present(t: Column) -> Column:
    return t.isNotNull() & ~F.isnan(t)


def _staged(df: DataFrame, **columns) -> DataFrame:
    """Adds columns one projection after another: a lambda would evaluate an inlined expression once for every element."""
    for name, make in columns.items():
        df = df.withColumn(name, make())
    return df


def _pieces(items: str, last: str, make) -> Column:
    """``make(slice)`` of the runs of the array column ``items`` that end at the indexes in the column ``last``."""
    before = F.concat(F.array(F.lit(-1)), F.slice(last, 1, F.greatest(F.size(last) - 1, F.lit(0))))
    cuts = F.arrays_zip(F.col(last).alias("e"), before.alias("b"))
    return F.transform(
        F.transform(cuts, lambda c: F.slice(F.col(items), c["b"] + 2, c["e"] - c["b"])),
        make,
    )


def with_sentences(df: DataFrame, words: str, name: str = "sentences") -> DataFrame:
    """Adds the sentences of timed words: one ends at a word that closes with ``. ! ?`` or that is the array's last.

    Untimed words are passed over before that test, so an untimed last word leaves what is unfinished without an end, and it is
    lost. Whether the next word is in upper case makes no difference.
    """
    w = F.col(words)
    df = _staged(
        df,
        _timed=lambda: F.filter(
            F.transform(w, lambda x, i: F.struct(strip(F.coalesce(x["word"], F.lit(""))).alias("word"), x["start"].alias("start"), x["end"].alias("end"), (i == F.size(w) - 1).alias("final"))),
            lambda x: _present(x["start"]) & _present(x["end"]),
        ),
        _last=lambda: F.filter(F.transform("_timed", lambda x, k: F.when(x["word"].rlike(SENTENCE_END) | x["final"], k)), lambda k: k.isNotNull()),
    )
    made = _pieces(
        "_timed",
        "_last",
        lambda ws: F.struct(
            cut_ms(F.get(ws, 0)["start"]).alias("start_ms"),
            cut_ms(F.element_at(ws, -1)["end"]).alias("end_ms"),
            F.trim(tight(F.array_join(F.transform(ws, lambda x: x["word"]), " "))).alias("text"),
        ),
    )
    return df.withColumn(name, F.when(F.size("_last") > 0, made).otherwise(F.array().cast(f"array<{SENTENCE}>"))).drop("_timed", "_last")


def from_start(found: Column, start_seconds: float = 0) -> Column:
    """Sentences that begin at or after a time, if one above zero is given."""
    return F.filter(found, lambda s: s["start_ms"] >= int(start_seconds * 1000)) if start_seconds > 0 else found


def chunks(found: Column, target: float | Column = 15.0, least: float = 1.0, most: float = 30.0) -> Column:
    """Greedy chunks of sentences. The open chunk takes the next sentence unless it reached the target (and the least), or
    would grow beyond ``most``; a chunk whose start is its end takes any. ``target`` is a number of seconds or an array with one
    for each chunk in turn (``targets``)."""
    if not 0 <= least <= most or (not isinstance(target, Column) and target <= 0):
        raise ValueError("chunks need 0 <= least <= most and a target above 0")
    seconds = lambda a, b: (b - a) / F.lit(1000.0)
    state = lambda closed, now, no: F.struct(closed.alias("closed"), now.alias("now"), no.alias("no"))
    begin = state(F.array().cast(f"array<{SENTENCE}>"), F.lit(None).cast(SENTENCE), F.lit(0))
    ended = lambda st: F.when(st["now"].isNull(), st["closed"]).otherwise(F.concat(st["closed"], F.array(st["now"])))

    def step(st: Column, s: Column) -> Column:
        now = st["now"]
        size = seconds(now["start_ms"], now["end_ms"])
        full = (size >= (F.get(target, st["no"] - 1) if isinstance(target, Column) else F.lit(target))) & (size >= least)
        takes = now.isNotNull() & ~full & ((now["start_ms"] == now["end_ms"]) | (seconds(now["start_ms"], s["end_ms"]) <= most))
        grown = F.struct(now["start_ms"].alias("start_ms"), s["end_ms"].alias("end_ms"), F.concat_ws(" ", now["text"], s["text"]).alias("text"))
        return F.when(takes, state(st["closed"], grown, st["no"])).otherwise(state(ended(st), s, st["no"] + 1))

    return F.aggregate(found, begin, step, ended)


def targets(key: Column, n: Column, mean: float = 15.0, spread: float = 5.0, least: float = 1.0, most: float = 30.0, uniform: bool = False, seed: int = 0) -> Column:
    """``n`` target lengths from ``least`` to ``most`` seconds: of a normal distribution, drawn anew while outside, or uniform.

    The draws depend on the seed and the key of the file only. Null keys have draws of their own; a null ``n`` gives none."""
    inside = 0.5 * (math.erf((most - mean) / (spread * math.sqrt(2))) - math.erf((least - mean) / (spread * math.sqrt(2)))) if spread > 0 else float(least <= mean <= most)
    if not 0 <= least <= most or most <= 0 or (not uniform and inside < 1e-6):
        raise ValueError("targets need 0 <= least <= most, and a distribution that reaches between them")

    @F.pandas_udf("array<double>")
    def draw(keys: pd.Series, counts: pd.Series) -> pd.Series:
        def one(k, count) -> list[float]:
            rng = random.Random(f"{seed}|{k}")
            out: list[float] = []
            while len(out) < count:
                x = rng.uniform(least, most) if uniform else rng.gauss(mean, spread)
                if least <= x <= most:
                    out.append(x)
            return out

        return pd.Series([one(k, 0 if c is None or c != c else int(c)) for k, c in zip(keys, counts)])

    return draw(key.cast("string"), n)


def chunk_status(start: Column, end: Column, least_ms: int = 200, length_ms: Column | None = None) -> Column:
    """``invalid`` if the start is not before the end (or the end of the media), ``short`` below the least, else ``kept``."""
    stop = F.least(end, length_ms) if length_ms is not None else end
    return F.when(start >= stop, "invalid").when(stop - start < least_ms, "short").otherwise("kept")


def with_legacy_sentences(df: DataFrame, words: str, name: str = "sentences") -> DataFrame:
    """Adds sentences of the older rule: they begin at a word in upper case after one that closes with ``. ! ?``; what is before
    the first word in upper case is dropped. Their status is ``start_missing``, ``end_missing``, ``short`` (below half a second)
    or ``kept``."""
    df = _staged(
        df,
        _all=lambda: F.transform(
            words,
            lambda x: F.struct(strip(F.coalesce(x["word"], F.lit(""))).alias("word"), x["start"].alias("start"), x["end"].alias("end")),
        ),
        _first=lambda: F.array_position(F.transform("_all", lambda x: x["word"].rlike(r"^\p{Lu}")), True),
        _kept=lambda: F.when(F.col("_first") > 0, F.slice("_all", F.col("_first").cast("int"), F.size("_all"))),
        # Each word beside the next one, so that no lambda reaches back into the whole array.
        _pairs=lambda: F.arrays_zip(F.col("_kept").alias("a"), F.slice("_kept", 2, F.size("_kept")).alias("b")),
        _last=lambda: F.filter(
            F.transform("_pairs", lambda x, k: F.when(x["b"].isNull() | (x["a"]["word"].rlike(SENTENCE_END) & x["b"]["word"].rlike(r"^\p{Lu}")), k)),
            lambda k: k.isNotNull(),
        ),
    )

    def make(ws: Column) -> Column:
        start, end = cut_ms(F.get(ws, 0)["start"]), cut_ms(F.element_at(ws, -1)["end"])
        status = F.when(start.isNull(), "start_missing").when(end.isNull(), "end_missing").when(end - start < 500, "short").otherwise("kept")
        text = tight(F.array_join(F.transform(ws, lambda x: x["word"]), " "), r"\s")
        return F.struct(start.alias("start_ms"), end.alias("end_ms"), text.alias("text"), status.alias("status"))

    return df.withColumn(name, F.when(F.size("_last") > 0, _pieces("_kept", "_last", make))).drop("_all", "_first", "_kept", "_pairs", "_last")


def exploded(df: DataFrame, key: str, found: Column, number: str) -> DataFrame:
    """``key, number, *members`` of an array of structs."""
    return df.select(key, F.posexplode(found).alias(number, "s")).select(key, number, "s.*")
