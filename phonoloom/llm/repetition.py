"""Repetition inside a single text, by zstandard compression bands and an exact count.

Every item is brought to its plain form (no case, no marks, look-alikes mapped), and the form is compressed as
a whole and in fixed chunks. A band with limits for the length tells repetitive text (it shrinks more than varied text
of its length does), incompressible text and the rest. The band describes an item and decides nothing: copies beyond the window
of zstandard or in short texts of many different characters hardly shrink. The exact share is counted for every item.

The repeated share is the share of words in runs of at least four words (in scripts without spaces: eight characters)
that already occurred earlier in the item.

Defined results: null and wordless texts have no words, share 0 and the band ``empty``. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonoloom.llm.forms import plain
from phonoloom.llm.sentences import remembered

WORD_RUN, CHAR_RUN, LEAST_SHARE = 4, 8, 0.5
CHUNK_BYTES = 4_096
#: Up to so many bytes of plain form, the least ratio of the ``repetitive`` band. Short texts pay for
#: the frame, so below the first length every item is counted exactly.
LIMITS = ((160, 0.0), (400, 1.5), (1_000, 1.7), (4_096, 2.0), (1 << 60, 2.4))
#: Below this ratio text of some length is as good as random.
INCOMPRESSIBLE, INCOMPRESSIBLE_FROM = 1.05, 400

_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]+")


@remembered
def _words_of(word: str) -> tuple[str, ...]:
    return tuple(_WORD.findall(plain(word)))


def units(text: str) -> tuple[list[str], int]:
    """Words of the plain form and the length of a run: words and four, or characters and eight."""
    words = [x for w in text.split() for x in _words_of(w)]
    whole = "".join(words)
    if not whole.isascii() and sum(map(len, _UNSPACED.findall(whole))) * 2 > len(whole):
        return list(whole), CHAR_RUN
    return words, WORD_RUN


def repeated_share(words: Sequence[str], run: int) -> float:
    """Share of ``words`` inside runs of at least ``run`` that already occurred earlier."""
    n = len(words)
    if n <= run:
        return 0.0
    grams = list(zip(*(words[k:] for k in range(run))))
    if len(set(grams)) == len(grams):
        return 0.0
    seen: set[tuple[str, ...]] = set()
    covered = 0
    upto = 0  # words before this index are counted
    for i, gram in enumerate(grams):
        if gram in seen:
            covered += i + run - max(upto, i)
            upto = i + run
        else:
            seen.add(gram)
    return covered / n


def ratios(words: Sequence[str], run: int, press: zstandard.ZstdCompressor) -> tuple[int, float, float]:
    """Bytes of the plain form, ratio of the whole and the highest ratio of a fixed chunk."""
    form = ("" if run == CHAR_RUN else " ").join(words).encode()
    if not form:
        return 0, 0.0, 0.0
    whole = len(form) / len(press.compress(form))
    chunks = [form[k : k + CHUNK_BYTES] for k in range(0, len(form), CHUNK_BYTES)] if len(form) > CHUNK_BYTES else []
    return len(form), whole, max((len(c) / len(press.compress(c)) for c in chunks), default=whole)


def band(size: int, whole: float, chunk: float) -> str:
    if not size:
        return "empty"
    least = next(limit for upto, limit in LIMITS if size <= upto)
    if max(whole, chunk) >= least:
        return "repetitive"
    return "incompressible" if size >= INCOMPRESSIBLE_FROM and whole < INCOMPRESSIBLE else "ordinary"


def repetition(df: DataFrame, key: str, text: Column, found_only: bool = False) -> DataFrame:
    """``item_id, n_units, ratio, chunk_ratio, band, repeated_share`` of each item.

    With ``found_only`` only items of at least ``LEAST_SHARE`` come out, whatever their band.
    """
    columns = ["item_id", "n_units", "ratio", "chunk_ratio", "band", "repeated_share"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            rows = []
            for k, t in zip(batch["k"].tolist(), batch["text"]):
                words, length = units(t) if t else ([], WORD_RUN)
                size, whole, chunk = ratios(words, length, press)
                name = band(size, whole, chunk)
                share = repeated_share(words, length)
                if not found_only or share >= LEAST_SHARE:
                    rows.append((k, len(words), whole, chunk, name, share))
            yield pd.DataFrame(rows, columns=columns)

    shape = "item_id bigint, n_units int, ratio double, chunk_ratio double, band string, repeated_share double"
    return df.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), text.alias("text")).mapInPandas(run, shape)


