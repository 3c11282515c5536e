"""Oversized items cut into pieces under a limit, at natural boundaries where there are any.

Items are rows of timed words; the size of a stretch is the reach of its timed words, from the earliest start to the
latest end. A row over the limit is split by a recursive hierarchy of separators: sections (a sentence end with a
silence), paragraphs (a silence), sentences, words, and, for a word that is itself too long, its characters. A part is only
split at the next finer level if it does not fit. Parts are then packed greedily, and each later piece begins with
the last words of the one before. How far down the recursion had to go is the row's kind of cut: ``forced`` if some part had to
be split between the words of a sentence or below, else ``natural``.

Defined results: times that are missing, NaN, infinite, negative or not increasing belong to no timed word; such words
stay in their place and take no time. Pieces never exceed the limit: where the overlap itself would break it, only as
many of the overlapping words are repeated as fit. Rows within the limit, null and empty arrays give nothing. Rows that
come twice count once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import floor, isfinite

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonoloom.llm.sentences import Model, segment
from phonoloom.operators.intervals import is_timed, seconds_to_ms

LIMIT_MS, SILENCE_MS, OVERLAP_WORDS = 30_000, 1_000, 2
_ENDLESS = 1 << 62
#: Separators, the coarsest first: a boundary of a level is one of every finer level.
SECTION, PARAGRAPH, SENTENCE, WORD, CHARACTER = 3, 2, 1, 0, -1


@dataclass
class Timeline:
    """Starts and ends in ms (None: not timed) and the separator after each word: ``WORD`` is none of the natural ones."""

    starts: list[int | None]
    ends: list[int | None]
    after: list[int]

    def reach(self, a: int, b: int) -> int:
        lo, hi = _ENDLESS, -1
        for s, e in zip(self.starts[a : b + 1], self.ends[a : b + 1]):
            if s is not None:
                lo, hi = min(lo, s), max(hi, e)
        return hi - lo if hi >= 0 else 0


def milliseconds(t: float | None) -> int | None:
    return floor(t * 1000 + 0.5) if t is not None and isfinite(t) else None


def timeline(model: Model, words: Sequence[str | None], starts: Sequence[float | None], ends: Sequence[float | None]) -> Timeline:
    s_ms: list[int | None] = []
    e_ms: list[int | None] = []
    for s, e in zip(starts, ends):
        timed = s is not None and e is not None and isfinite(s) and isfinite(e) and 0 <= s < e
        s_ms.append(milliseconds(s) if timed else None)
        e_ms.append(milliseconds(e) if timed else None)
    after = [0] * len(words)
    for _, b in segment(model, words):
        after[b] += SENTENCE
    latest = None
    for i, (s, e) in enumerate(zip(s_ms, e_ms)):
        if s is None:
            continue
        if latest is not None and s - latest >= SILENCE_MS:
            after[i - 1] += PARAGRAPH
        latest = e if latest is None else max(latest, e)
    return Timeline(s_ms, e_ms, after)


def split(line: Timeline, a: int, b: int, level: int, limit: int) -> list[tuple[int, int, int]]:
    """Parts of words a to b and the level that they were cut at. ``level`` is the separator that is tried first; a part that does
    not fit is split at the next finer one. A part of one word that does not fit is left for its characters."""
    if line.reach(a, b) <= limit:
        return [(a, b, level + 1)]
    if a == b or level < WORD:
        return [(a, b, CHARACTER)]
    out, first = [], a
    for i in range(a, b + 1):
        if i == b or line.after[i] >= level:
            out += split(line, first, i, level - 1, limit)
            first = i + 1
    return out


def pack(line: Timeline, limit: int = LIMIT_MS, overlap: int = OVERLAP_WORDS) -> tuple[list[tuple[int, int, int]], str]:
    """Pieces (first word, last word, words repeated from the piece before), and the kind of cut."""
    parts = split(line, 0, len(line.starts) - 1, SECTION, limit)
    kind = "forced" if min(p[2] for p in parts) <= WORD else "natural"
    todo = parts[::-1]
    out: list[tuple[int, int, int]] = []
    begin, last, repeated = 0, -1, 0
    while todo:
        a, b, level = todo.pop()
        if last >= begin + repeated and line.reach(begin, b) <= limit or last < 0:
            last = b
            continue
        if last >= begin + repeated:
            out.append((begin, last, repeated))
            repeated = min(overlap, last - begin + 1)
            begin = last + 1 - repeated
        if line.reach(begin, b) > limit:
            if a < b:  # it fits alone, but not after the repeated words: it is split more finely
                todo += finer(line, a, b)[::-1]
                continue
            while repeated and line.reach(begin, b) > limit:
                begin, repeated = begin + 1, repeated - 1
        last = b
    if last >= begin + repeated:
        out.append((begin, last, repeated))
    return out, kind


def finer(line: Timeline, a: int, b: int) -> list[tuple[int, int, int]]:
    """Words a to b cut at their coarsest separators."""
    level = max(line.after[a:b])
    ends = [i for i in range(a, b) if line.after[i] >= level] + [b]
    return [(x, y, level) for x, y in zip([a, *(e + 1 for e in ends)], ends)]


def slices(word: str, start: int, end: int, limit: int) -> list[tuple[str, int, int]]:
    """A word over the limit, cut between characters into stretches of time within it."""
    n = max(2, -(-(end - start) // limit))
    at = lambda k: start + (end - start) * k // n
    char = lambda k: len(word) * k // n
    return [(word[char(k) : char(k + 1)], at(k), at(k + 1)) for k in range(n)]


def _oversized(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Rows over the limit, decided by built-in expressions before any row goes to Python."""
    timed = F.filter("word_segments", lambda w: is_timed(w["start"], w["end"]))
    reach = F.array_max(F.transform(timed, lambda w: seconds_to_ms(w["end"]))) - F.array_min(F.transform(timed, lambda w: seconds_to_ms(w["start"])))
    part = lambda f: F.transform("word_segments", lambda w: w[f]).alias(f)
    return df.filter(F.col(key).isNotNull() & (reach > limit)).select(F.col(key).alias("k"), part("word"), part("start"), part("end"))


def _lines(batch: pd.DataFrame, model: Model) -> Iterator[tuple[int, list, Timeline]]:
    for k, w, s, e in zip(batch["k"].tolist(), batch["word"], batch["start"], batch["end"]):
        num = lambda xs: [None if x is None or x != x else float(x) for x in xs]
        yield k, list(w), timeline(model, list(w), num(s), num(e))


def cut_kinds(df: DataFrame, key: str, model: Model, limit: int = LIMIT_MS, overlap: int = OVERLAP_WORDS) -> DataFrame:
    """``key, cut_kind`` of each row over the limit, from the cutting of its pieces."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(k, pack(x, limit, overlap)[1]) for k, _, x in _lines(batch, model)], columns=[key, "cut_kind"])

    return _oversized(df, key, limit).mapInPandas(run, f"`{key}` bigint, cut_kind string").distinct()


def pieces(df: DataFrame, key: str, model: Model, limit: int = LIMIT_MS, overlap: int = OVERLAP_WORDS) -> DataFrame:
    """``key, piece_no, first_word, last_word, repeated_words, start_ms, end_ms, text`` of each row over the limit.

    The slices of a word over the limit share its index.
    """
    columns = [key, "piece_no", "first_word", "last_word", "repeated_words", "start_ms", "end_ms", "text"]

    def of(k: int, words: list, line: Timeline) -> Iterator[tuple]:
        no = 0
        for a, b, repeated in pack(line, limit, overlap)[0]:
            if a == b and line.reach(a, a) > limit:
                for text, s, e in slices(words[a] or "", line.starts[a], line.ends[a], limit):
                    yield k, no, a, a, 0, s, e, text
                    no += 1
                continue
            times = [(s, e) for s, e in zip(line.starts[a : b + 1], line.ends[a : b + 1]) if s is not None]
            s, e = (min(t[0] for t in times), max(t[1] for t in times)) if times else (None, None)
            yield k, no, a, b, repeated, s, e, " ".join(w for w in words[a : b + 1] if w)
            no += 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r for k, w, x in _lines(batch, model) for r in of(k, w, x)]
            yield pd.DataFrame(rows, columns=columns).astype({"start_ms": "Int64", "end_ms": "Int64"})

    shape = f"`{key}` bigint, piece_no int, first_word int, last_word int, repeated_words int, start_ms bigint, end_ms bigint, text string"
    return _oversized(df, key, limit).mapInPandas(run, shape).distinct()
