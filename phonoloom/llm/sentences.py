"""Sentence units of word lists in any script, by semi-Markov dynamic programming over whole spans.

A span may only end at a *candidate*: a word that closes with a sentence mark, or such a mark standing as a word of its
own. The best segmentation maximises, jointly, the evidence at each chosen end (kind of mark, abbreviation class,
case, how often the next word opens sentences and the last word closes them) and the evidence of each whole span
(its length against the length model, balanced quotations, a reporting verb without a quotation). Opening, closing and
length statistics are counted over all rows of the clean samples and, where they are given, all rows to be segmented; each
partition adds up its own, and the driver gets one row of sums for each key. In rows that are not clean, a word behind a doubtful
mark or at the edge of a row or quotation is evidence of nothing.

Defined results: every word, empty and null ones included, is in exactly one sentence; marks standing alone belong to
the sentence they close; the last sentence ends with the row. A null or empty array has no sentences. Rows that come
twice count once. A span may hold any number of candidates; beginnings that cannot win any more are not tried.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from hashlib import blake2b

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonoloom.llm.forms import plain, tidy

#: What is counted of a key: beginnings of sentences, other beginnings and those of them in upper case, ends of sentences, other ends.
COUNTS = OPENING, INNER, INNER_UPPER, CLOSING, GOING = "opening", "inner", "inner_upper", "closing", "going"
#: Keys that a partition counts before it hands them on, and keys whose counts a model keeps at hand.
TALLY_KEYS = 100_000
#: Keys of rows delivered more than once that are worth a broadcast.
BROADCAST_ROWS = 100_000

# Abbreviations by how they stand to the end of a sentence.
TITLES = "mr mrs ms dr prof st sr sra srta sto sta hr fr frl mme mlle mgr ifj id özv szt д-р г гг св проф акад أ د م श्री डॉ प्रो पं सुश्री".split()
INSIDE = (
    "e.g i.e cf vs approx ca no nr vol p pp fig viz bzw vgl z.b d.h kb pl ún ill c.-à-d p.ex env chap pág págs p.ej ej aprox núm "
    "т.е напр прим ок см стр рис англ ص लग उदा सं क्र"
).split()
CLOSING = "etc stb usw u.a inc ltd co corp s.a s.l zrt kft nyrt bt gmbh ag a.m p.m др т.д т.п пр إلخ".split()
# Verbs that report a quotation and make no sentence of their own without one.
REPORTING = "shouted cried exclaimed kiáltotta rief criait gritó gritaba крикнул крикнула 喊道 叫んで पुकारा صاح هتف".split()
# A particle that ties a closed quotation to what follows.
QUOTATIVE = ("と",)
# Marks.
ENDS, ELLIPSIS, DOT = "!?。！？।॥؟", "…", "."
OPENERS, CLOSERS, EITHER = "„«「『‹〈《", "”»」』›〉》", "\"“"
_TAIL = regex.compile(r"[.!?…。！？।॥؟\"”“»」』›〉》'’)\]}]+$")
_HEAD = regex.compile(r"^[\"“„«「『‹〈《'‘(\[{¿¡]+")
_EDGE = regex.compile(r"^[^\p{L}\p{N}\p{M}]+|[^\p{L}\p{N}\p{M}]+$")
_NO_SPACES = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]")
_INITIAL = regex.compile(r"^\p{L}\p{M}*(?:\.\p{L})?$")


def _fold(words: str | list[str]) -> set[str]:
    return {plain(w) for w in words}


_TITLES, _INSIDE, _CLOSING, _REPORTING = map(_fold, (TITLES, INSIDE, CLOSING, REPORTING))
_REPORT_CJK = [w for w in REPORTING if _NO_SPACES.match(w)]


def hashed(key: str) -> int:
    return int.from_bytes(blake2b(key.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@dataclass
class Model:
    """``COUNTS`` of the keys of words, by their sorted hashes, and the log-length of sentences."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros((0, len(COUNTS)), np.int64))
    length: dict = field(default_factory=lambda: {"words": (2.4, 0.35), "chars": (3.0, 0.3)})

    def __post_init__(self) -> None:
        self._known: dict[str, tuple[int, ...]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}}

    def of(self, key: str) -> tuple[int, ...]:
        """The counts of a key."""
        if (got := self._known.get(key)) is None:
            h = hashed(key)
            at = int(self.hashes.searchsorted(h))
            got = tuple(self.counts[at].tolist()) if at < len(self.hashes) and self.hashes[at] == h else (0,) * len(COUNTS)
            if len(self._known) >= TALLY_KEYS:
                self._known.clear()
            self._known[key] = got
        return got

    def seen(self, key: str) -> bool:
        first, inner, *_ = self.of(key)
        return first + inner > 0

    def opens(self, key: str, upper: bool) -> float:
        """Log odds that a sentence begins with a word; one in upper case is only held against others in upper case."""
        first, inner, inner_upper, _, _ = self.of(key)
        if not first + inner:
            return 0.0
        return max(-3.0, min(3.0, math.log((first + 0.3) / ((inner_upper if upper else inner) + 0.3))))

    def closes(self, key: str) -> float:
        first, inner, _, last, going = self.of(key)
        return 0.0 if not first + inner else max(-2.0, min(2.0, math.log((last + 0.3) / (going + 0.3))))


class _Memory(dict):
    """Values of a function of a word, remembered for words of usual length: most words of a corpus come again and again."""

    def __init__(self, f) -> None:
        super().__init__()
        self.f = f

    def __missing__(self, word: str):
        value = self.f(word)
        if len(word) <= 40:
            if len(self) >= 100_000:
                self.clear()
            self[word] = value
        return value


def remembered(f):
    return _Memory(f).__getitem__


@remembered
def clean(word: str) -> str:
    return tidy(word).strip()


@remembered
def core(word: str) -> str:
    return _EDGE.sub("", word)


@remembered
def folded(word: str) -> str:
    """The core of a word without case and odd characters."""
    return plain(core(word))


@remembered
def unspaced(word: str) -> bool:
    """Whether a word begins in a script without spaces."""
    return bool(_NO_SPACES.match(word))


@remembered
def _real(word: str) -> bool:
    return word[:1].isalnum() or bool(core(word))


@remembered
def _edges(word: str) -> tuple[str, str]:
    """Opening and closing marks of a word."""
    head, tail = _HEAD.match(word), _TAIL.search(word)
    return head[0] if head else "", tail[0] if tail else ""


def split_words(text: str) -> list[str]:
    """Words of a text: by white space, and one for each character in scripts without spaces."""
    out: list[str] = []
    for w in text.split():
        if _NO_SPACES.search(w):
            out += regex.findall(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]|[^\p{Han}\p{Hiragana}\p{Katakana}ー\p{P}]+(?:\.\p{N}+)*|\p{P}", w)
        else:
            out.append(w)
    return out


def _next_key(words: Sequence[str], i: int) -> tuple[str, str]:
    """The key of what begins at word i, and the first word as it is written."""
    while i < len(words) and not core(words[i]):
        i += 1
    if i >= len(words):
        return "", ""
    w = words[i][len(_edges(words[i])[0]) :]
    if unspaced(w):
        return core("".join(words[i : i + 4]))[:2], w
    return folded(w), w


def _last_key(words: Sequence[str], i: int) -> str:
    """The key of what ends with word i."""
    while i >= 0 and not core(words[i]):
        i -= 1
    if i < 0:
        return ""
    if unspaced(core(words[i])):
        return core("".join(words[max(0, i - 3) : i + 1]))[-2:]
    return folded(words[i])


def _kind(word: str, mark: str) -> str:
    """Of a word that closes with ``mark``: hard, dots, plain, title, inside, closing or number."""
    if any(c in ENDS for c in mark):
        return "hard"
    if ELLIPSIS in mark or ".." in mark:
        return "dots"
    c = folded(word)
    if c in _CLOSING:
        return "closing"
    if c in _TITLES:
        return "title"
    if c in _INSIDE:
        return "inside"
    if c[-1:].isdigit():
        return "number"
    if _INITIAL.match(c) and not _NO_SPACES.match(c):
        return "title"
    return "plain"


_BASE = {"hard": 5.0, "plain": 5.0, "dots": -0.5, "closing": 3.0, "title": -7.0, "inside": -6.0, "number": -4.0}
_UNBALANCED, _NO_QUOTE, _LATE_QUOTE = 6.0, 4.0, 5.0


def scan(words: Sequence[str]) -> tuple[list[tuple[int, str, bool]], list[int]]:
    """Candidates (index, kind, whether a quotation closes there) and the depth of quotations after each word."""
    found: list[tuple[int, str, bool]] = []
    depth, now = [], 0
    n = len(words)
    for i, w in enumerate(words):
        if not w or (w[-1].isalnum() and w[0].isalnum()):
            depth.append(now)
            continue
        c = core(w)
        if not c:
            # Marks standing alone: they close what is before them, or open what follows.
            ends = [x for x in w if x in ENDS or x in ELLIPSIS or x == DOT]
            closes = False
            for x in w:
                if x in CLOSERS or (x in EITHER and now > 0):
                    now, closes = now - 1, True
                elif x in OPENERS or x in EITHER:
                    now += 1
            depth.append(now)
            if ends:
                before, after = _near(words, i, -1), _near(words, i, 1)
                if w == DOT and before[-1:].isdigit() and after[:1].isdigit():
                    continue
                kind = _kind(before, w)
                if w == DOT and kind in ("title", "number") and _NO_SPACES.match(after):
                    kind = "plain"
                if found and found[-1][0] == i - 1:
                    kind = "hard" if "hard" in (kind, found[-1][1]) else found[-1][1]
                    closes = closes or found[-1][2]
                    found.pop()
                found.append((i, kind, closes))
            elif closes and found and found[-1][0] == i - 1:
                found[-1] = (i, found[-1][1], True)
            continue
        head, tail = _edges(w)
        now += sum(x in OPENERS or x in EITHER for x in head)
        closes = False
        if tail:
            shut = sum(x in CLOSERS or x in EITHER for x in tail)
            now, closes = now - shut, shut > 0
            if any(x in ENDS or x in ELLIPSIS or x == DOT for x in tail):
                found.append((i, _kind(w, tail), closes))
        depth.append(now)
    return [x for x in found if x[0] < n - 1], depth


def _near(words: Sequence[str], i: int, step: int) -> str:
    j = i + step
    while 0 <= j < len(words) and not words[j]:
        j += step
    return words[j] if 0 <= j < len(words) else ""


def boundary_score(model: Model, words: Sequence[str], at: int, kind: str, closes: bool) -> float:
    key, following = _next_key(words, at + 1)
    sure = kind in ("hard", "plain", "closing")
    opens, ends = model.opens(key, following[:1].isupper()), 0.7 * model.closes(_last_key(words, at))
    first = following[:1]
    if sure and not closes:
        # A clear mark outside a quotation: what follows can only weaken it, odd starts in lower case included.
        score = _BASE[kind] + max(-1.5, min(1.5, opens)) + ends
        return score + (1.5 if first.isupper() else -1.5 if first.islower() else 0.0)
    score = (0.5 if sure else _BASE[kind]) + opens + ends
    if closes and following[:1] in QUOTATIVE:
        score -= 6.0
    if first.isupper():
        score += 1.5 + (0.5 if not model.seen(key) else 2.5 if sure else 0.0)
    elif first.islower():
        score -= 3.0
    return score


class Spans:
    """Scores of the spans of a list of words between its candidates (and its end)."""

    def __init__(self, model: Model, words: Sequence[str], cand: Sequence[tuple[int, str, bool]], depth: Sequence[int]) -> None:
        n = len(words)
        self.words, self.cand, self.depth = words, cand, depth
        self.ends = [c[0] for c in cand] + [n - 1]
        self.gain = [boundary_score(model, words, *c) for c in cand] + [0.0]
        self.count = [0]
        for w in words:
            self.count.append(self.count[-1] + _real(w))
        chars = sum(1 for w in words if len(w) <= 2 and not w.isascii() and unspaced(w)) * 2 > n
        self.mean, self.sd = model.length["chars" if chars else "words"]
        self.reports = [_reports(words, i) for i in range(n)] if any(c[2] for c in cand) else None

    def score(self, i: int, j: int) -> float:
        """Of the span from behind end i - 1 to end j, its end included; never above ``gain[j]``."""
        a, b = (0 if i == 0 else self.ends[i - 1] + 1), self.ends[j]
        size = self.count[b + 1] - self.count[a]
        z = (math.log(size) - self.mean) / self.sd if size else -4.0
        score = self.gain[j] - min(2.0, 0.15 * z * z)
        if self.depth[b] != (self.depth[a - 1] if a else 0):
            score -= _UNBALANCED
        if j < len(self.cand) and self.cand[j][2] and not _opens_quoted(self.words, a, b):
            score -= _LATE_QUOTE  # a quotation begun inside a sentence is rarely its end
        if self.reports and i > 0 and any(self.reports[a : b + 1]) and not _quoted(self.words, a, b, self.depth):
            score -= _NO_QUOTE
        return score


def value_of(model: Model, words: Sequence[str], chosen: Sequence[tuple[int, str, bool]]) -> float:
    """Score of the segmentation that ends sentences at the chosen candidates."""
    cand, depth = scan(words)
    spans = Spans(model, words, [c for c in cand if c[0] < len(words) - 1], depth)
    at = {b: k for k, b in enumerate(spans.ends)}
    total, i = 0.0, 0
    for j in [at[c[0]] for c in chosen] + [len(spans.ends) - 1]:
        total += spans.score(i, j)
        i = j + 1
    return total


def segment(model: Model, raw: Sequence[str | None]) -> list[tuple[int, int]]:
    """First and last index of each sentence of a list of words."""
    n = len(raw)
    if not n:
        return []
    words = [clean(w) if w else "" for w in raw]
    cand, depth = scan(words)
    last_real = n - 1
    while last_real > 0 and not words[last_real]:
        last_real -= 1
    cand = [c for c in cand if c[0] < last_real]
    if not cand:
        return [(0, n - 1)]
    spans = Spans(model, words, cand, depth)
    m = len(spans.ends)
    best = [0.0] + [-1e18] * m  # best[j]: of the words up to end j - 1
    top = [0.0] * (m + 1)  # the greatest of best[0] to best[j]
    back = [0] * (m + 1)
    for j in range(1, m + 1):
        for i in range(j - 1, -1, -1):
            if top[i] + spans.gain[j - 1] <= best[j]:
                break  # no earlier beginning can reach what is found: no span scores above its gain
            if best[i] + spans.gain[j - 1] > best[j] and (score := best[i] + spans.score(i, j - 1)) > best[j]:
                best[j], back[j] = score, i
        top[j] = max(top[j - 1], best[j])
    out, j = [], m
    while j > 0:
        i = back[j]
        out.append((0 if i == 0 else spans.ends[i - 1] + 1, spans.ends[j - 1]))
        j = i
    return out[::-1]


def _opens_quoted(words: Sequence[str], a: int, b: int) -> bool:
    """Whether the first word of a span begins a quotation."""
    while a < b and not words[a]:
        a += 1
    return any(x in OPENERS or x in EITHER for x in _edges(words[a])[0])


def _reports(words: Sequence[str], i: int) -> bool:
    w = words[i]
    if not w:
        return False
    if not w.isascii() and unspaced(w):
        return any("".join(words[i : i + len(v)]) == v for v in _REPORT_CJK)
    return folded(w) in _REPORTING


def _quoted(words: Sequence[str], a: int, b: int, depth: Sequence[int]) -> bool:
    start = depth[a - 1] if a else 0
    return any(depth[k] != start for k in range(a, b + 1)) or any(w and w[0] in OPENERS + EITHER for w in words[a : b + 1])


@remembered
def _facts(word: str) -> tuple[bool, str, bool, bool] | None:
    """Of a word, None for marks: whether it is in a script without spaces, its key else, whether it is in upper case and begins a quotation."""
    if not core(word):
        return None
    head = _edges(word)[0]
    w = word[len(head) :]
    return unspaced(w) or unspaced(core(word)), folded(w), w[:1].isupper(), any(x in OPENERS or x in EITHER for x in head)


@remembered
def _quotes(word: str) -> bool:
    return any(x in OPENERS or x in EITHER or x in CLOSERS for x in word)


class Tally:
    """Counts of lists of words, split where a mark can hardly be anything else."""

    def __init__(self) -> None:
        self.keys: defaultdict[str, list[int]] = defaultdict(lambda: [0] * len(COUNTS))
        self.lengths: Counter = Counter()

    def add(self, words: Sequence[str], whole: bool) -> None:
        """Counts a list of words. ``whole``: a clean text, which has sentence ends at sure marks and its edges and nowhere else."""
        sure, unsure = 1, 2
        mark = {}
        for i, kind, closes in scan(words)[0]:
            if kind in ("hard", "plain") and not _next_key(words, i + 1)[1][:1].islower() and (whole or not closes):
                mark[i] = sure
            elif not whole:
                mark[i] = unsure
        real = [(k, f) for k, f in enumerate(map(_facts, words)) if f]
        if not real:
            return
        edge, keys = sure if whole else unsure, self.keys
        before, begun, first = edge, whole, 1
        for n, (k, (dense, key, upper, _)) in enumerate(real, 1):
            begins = keys[_next_key(words, k)[0] if dense else key]
            ends = keys[_last_key(words, k)] if dense else begins
            if not before:
                begins[1] += 1
                begins[2] += upper
            elif before == sure:
                begins[0] += 1
                begun, first = True, n
            else:
                begun = False
            if n == len(real):
                after = edge
            else:
                following, (_, _, _, quoted) = real[n]
                after = mark.get(k, 0) if following == k + 1 else max(mark.get(i, 0) for i in range(k, following))
                if not after and not whole and (quoted or following > k + 1 and any(map(_quotes, words[k + 1 : following]))):
                    after = unsure
            if not after:
                ends[4] += 1
            elif after == sure:
                ends[3] += 1
                if begun:
                    self.lengths["chars" if unspaced(core(words[real[first - 1][0]])) else "words", n + 1 - first] += 1
            before = after

    def rows(self) -> list[tuple]:
        """``unit, key`` and counts: of keys by their hashes, and of lengths in a unit by the length."""
        return [("", hashed(k), *c) for k, c in self.keys.items()] + [(unit, size, c, 0, 0, 0, 0) for (unit, size), c in self.lengths.items()]


def _model(unit: Sequence[str], key: np.ndarray, counts: np.ndarray) -> Model:
    """A model of the rows of a tally, one for each unit and key."""
    unit = np.asarray(unit, object)
    at = np.flatnonzero(unit == "")
    at = at[np.argsort(key[at])]
    model = Model(key[at], counts[at])
    for name in model.length:
        sizes = sorted(zip(key[unit == name].tolist(), counts[unit == name, 0].tolist()))
        total = sum(c for _, c in sizes)
        if total > 20:
            mean = math.fsum(c * math.log(n) for n, c in sizes) / total
            model.length[name] = (mean, max(0.35, (math.fsum(c * (math.log(n) - mean) ** 2 for n, c in sizes) / total) ** 0.5))
    return model


def _clean_words(text: str) -> list[str]:
    return [tidy(w) for w in split_words(text)]


def train(texts: Iterable[str]) -> Model:
    """A model of all of some clean texts."""
    tally = Tally()
    for text in texts:
        tally.add(_clean_words(text), True)
    rows = tally.rows()
    return _model([r[0] for r in rows], np.array([r[1] for r in rows], np.int64), np.array([r[2:] for r in rows], np.int64).reshape(-1, len(COUNTS)))


def _tallied(df: DataFrame, whole: bool) -> DataFrame:
    """Sums of the partitions of ``words`` (of ``whole`` texts: one text), for each number of ``copies`` that its rows come in."""
    columns = ["copies", "unit", "key", *COUNTS]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tallies: dict[int, Tally] = {}
        for batch in batches:
            for words, copies in zip(batch["words"], batch["copies"].tolist()):
                tally = tallies.setdefault(copies, Tally())
                tally.add(_clean_words(words) if whole else [clean(w) if w else "" for w in words], whole)
                if len(tally.keys) >= TALLY_KEYS:
                    yield pd.DataFrame([(copies, *r) for r in tallies.pop(copies).rows()], columns=columns)
        yield pd.DataFrame([(c, *r) for c, t in tallies.items() for r in t.rows()], columns=columns)

    shape = "copies bigint, unit string, key bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return df.filter(F.col("words").isNotNull()).select("words", "copies").mapInPandas(run, shape)


def _with_copies(df: DataFrame, key: str) -> DataFrame:
    """``df`` with the number of rows that share its key; rows with a null key are left out."""
    df = df.filter(F.col(key).isNotNull())
    again = df.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")
    again = F.broadcast(again) if again.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else again
    return df.join(again, key, "left").withColumn("copies", F.coalesce("copies", F.lit(1)))


def trained(*samples: DataFrame, column: str = "text", rows: DataFrame | None = None, key: str = "align_id", words: str = "words") -> Model:
    """A model of all rows of clean samples and, where they are given, of all ``rows`` with lists of words; one that comes in
    copies of the same key counts once."""
    parts = [_tallied(s.select(F.col(column).alias("words"), F.lit(1).cast("bigint").alias("copies")), True) for s in samples]
    if rows is not None:
        parts.append(_tallied(_with_copies(rows.select(key, F.col(words).alias("words")), key), False))
    # Each copy of a row has been counted, so their sums are whole multiples.
    sums = [F.round(F.sum(F.col(c) / F.col("copies"))).cast("bigint").alias(c) for c in COUNTS]
    got = reduce(DataFrame.unionByName, parts).groupBy("unit", "key").agg(*sums).toArrow()
    counts = np.stack([got.column(c).to_numpy() for c in COUNTS], 1) if got.num_rows else np.zeros((0, len(COUNTS)), np.int64)
    return _model(got.column("unit").to_pylist(), got.column("key").to_numpy(), counts)


def sentence_units(df: DataFrame, key: str, words: Column, model: Model) -> DataFrame:
    """``key, first_word, last_word`` of each sentence of each row; rows with a null key are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, a, b) for k, ws in zip(batch["k"].tolist(), batch["words"]) if ws is not None for a, b in segment(model, ws)]
            yield pd.DataFrame(rows, columns=[key, "first_word", "last_word"])

    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), words.alias("words"))
    return rows.mapInPandas(run, f"`{key}` bigint, first_word int, last_word int").distinct()
