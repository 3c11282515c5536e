"""Language of texts and of their parts, by string-kernel classification.

The kernel is the blended spectrum of n-gram presence: the number of character n-grams (of 1 to ``MAX_N`` characters) that
two texts share, normalised by their own numbers. Landmarks (at most ``LANDMARKS`` clean samples, taken evenly from each
language) give the Nyström map; one-versus-rest kernel ridge regression on the mapped samples gives a weight for each
language. The map is linear in the n-grams, so a batch of texts is scored by two matrix products: presence of n-grams times
landmark n-grams, times the weights of the map; workers use their product, folded once.

Parts (lines or segments) are scored, weighted by nothing but themselves: the main language of an item is that of most of
its parts with words; ties go to the language with more characters, then the first by name.

Defined results: parts without a word have no language and are no cases; null and wordless items have none either.
Confidence is the softmax of the scores, from 0 to 1. The samples are a fixed, bounded table (``SAMPLE_ROWS``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonoloom.llm.forms import bare
from phonoloom.llm.sentences import remembered

SAMPLE_ROWS, LANDMARKS, MAX_N, RIDGE = 5_000, 400, 4, 0.05
#: Texts scored at once: their n-grams should stay in a core's cache.
BATCH = 256
#: n-grams are told apart by a hash of so many bits.
BITS = 22
#: How sharply scores become confidences.
SHARPNESS = 6.0
#: What is no speech: tags, links, names before a number and colon, and caption marks, which are short; longer text in brackets
#: is speech.
_MARKUP = regex.compile(r"\[[^\]\n]{0,40}\]|\([^)\n]{0,40}\)|<[^>\n]*>|https?://\S+|^\s*\p{L}+ \p{N}+:", regex.MULTILINE)
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")

# Names and codes of the languages in their usual spellings.
NAMES = {
    "en": "en eng english", "hu": "hu hun hungarian magyar", "de": "de deu ger german deutsch", "fr": "fr fra fre french français francais",
    "es": "es spa spanish español espanol castellano", "ru": "ru rus russian русский", "zh": "zh zho chi cmn chinese 中文 汉语 漢語",
    "ja": "ja jpn japanese 日本語", "ar": "ar ara arabic العربية", "hi": "hi hin hindi हिन्दी हिंदी",
}
_CODES = {n: code for code, names in NAMES.items() for n in names.split()}
# Codes that stand for no language, for several, or for a missing label.
_NO_LANGUAGE = {"und", "mul", "mis", "zxx", "nan", "na", "xx", "xxx"}


def label_language(label: str | None) -> str | None:
    """Two letters of the language that a label names in any spelling or region; for languages that are not among ``NAMES`` the
    code of two or three letters itself. None if it names none."""
    if not label:
        return None
    first = regex.split(r"[-_.\s]+", label.strip().casefold(), maxsplit=1)[0]
    return _CODES.get(first) or (first if regex.fullmatch("[a-z]{2,3}", first) and first not in _NO_LANGUAGE else None)


@remembered
def _normal_word(word: str) -> str:
    return _OTHER.sub(" ", bare(word)).strip()


def normal(text: str) -> str:
    """Words of a text without markup, case, accents and odd characters, so that none of these changes the language."""
    if any(c in text for c in "[(<:"):
        text = _MARKUP.sub(" ", text)
    return " ".join(filter(None, map(_normal_word, text.split())))


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each within blanks, and the number of the text of each."""
    padded = [f" {t} " for t in texts]
    flat = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return flat, np.repeat(np.arange(len(texts), dtype=np.int64), [len(p) for p in padded])


def presence(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, n-gram) without repeats, sorted by text."""
    flat, owner = _codes(texts)
    keys = []
    mult = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
    h = np.zeros(len(flat), np.uint64)
    for n in range(1, MAX_N + 1):
        m = len(flat) - n + 1
        if m <= 0:
            break
        h = h[:m] * mult[0] + flat[n - 1 :] + np.uint64(n)
        mixed = ((h ^ (h >> np.uint64(29))) * mult[1]) >> np.uint64(64 - BITS)
        same = owner[:m] == owner[n - 1 :]
        keys.append((owner[:m][same] << BITS) | mixed[same].astype(np.int64))
    pairs = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    pairs = pairs[np.flatnonzero(np.diff(pairs, prepend=-1))]
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Model:
    """``weights[slot[g]]`` is the row of n-gram g: landmark n-grams times the weights of the map, folded."""

    languages: list[str]
    slot: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """One row of scores per normal text."""
        if not len(texts):
            return np.zeros((0, len(self.languages)))
        row, gram = presence(texts)
        norm = np.sqrt(np.maximum(np.bincount(row, minlength=len(texts)), 1))
        at = self.slot[gram]
        hit = at >= 0
        row, at = row[hit], at[hit]
        out = np.zeros((len(texts), len(self.languages)))
        if len(row):
            # The sparse presence matrix times the weights: rows are sorted, so their products are segment sums.
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            out[row[starts]] = np.add.reduceat(self.weights[at], starts, axis=0)
        return out / norm[:, None] + self.bias


def fit(texts: Sequence[str], labels: Sequence[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nyström map on landmarks of every language, then ridge regression of one language against the rest."""
    languages = sorted(set(labels))
    forms = [normal(t) for t in texts]
    # Whole samples and their sentences: parts to be scored are as short as a sentence.
    pairs = [(f, y) for f, y in zip(forms, labels) if f]
    pairs += [(p, y) for t, y in zip(texts, labels) for p in (normal(s) for s in regex.split(r"(?<=[.!?。！？।؟…])\s*", t)) if len(p) > 3]
    docs, y = [p for p, _ in pairs], np.array([languages.index(v) for _, v in pairs])
    row, gram = presence(docs)
    known, col = np.unique(gram, return_inverse=True)
    dense = np.zeros((len(docs), len(known)), np.float32)
    dense[row, col] = 1.0
    dense /= np.sqrt(np.maximum(dense.sum(1, keepdims=True), 1))
    chosen = np.concatenate([np.flatnonzero(y == k)[: max(1, landmarks // len(languages))] for k in range(len(languages))])
    marks = dense[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])  # the Nyström map: kernel with the landmarks times this
    mapped = (dense @ marks.T).astype(np.float64) @ half
    target = np.where(np.arange(len(languages))[None, :] == y[:, None], 1.0, -1.0)
    mean = mapped.mean(0)
    centred = mapped - mean
    beta = np.linalg.solve(centred.T @ centred + ridge * np.eye(centred.shape[1]), centred.T @ (target - target.mean(0)))
    weights = (marks.T.astype(np.float64) @ (half @ beta)).astype(np.float32)
    slot = np.full(1 << BITS, -1, np.int32)
    slot[known] = np.arange(len(known), dtype=np.int32)
    return Model(languages, slot, weights, target.mean(0) - mean @ beta)


def trained(*samples: DataFrame, text: str = "text", label: str = "lang", key: str = "sample_id") -> Model:
    """A model of at most ``SAMPLE_ROWS`` rows of each clean sample, the first in the order of their keys."""
    rows: list[tuple[str, str]] = []
    for s in samples:
        got = s.filter(F.col(text).isNotNull() & F.col(label).isNotNull()).select(key, text, label).orderBy(key, text).limit(SAMPLE_ROWS).collect()
        rows += [(r[1], label_language(r[2]) or r[2]) for r in got]
    return fit([t for t, _ in rows], [y for _, y in rows])


def confidences(scores: np.ndarray) -> np.ndarray:
    e = np.exp(SHARPNESS * (scores - scores.max(1, keepdims=True)))
    return e / e.sum(1, keepdims=True)


def main_language(parts: Sequence[tuple[str, int]]) -> str:
    """Of (language, characters) of the parts with words."""
    count: dict[str, list[int]] = {}
    for lang, size in parts:
        c = count.setdefault(lang, [0, 0])
        c[0] += 1
        c[1] += size
    return min(count, key=lambda k: (-count[k][0], -count[k][1], k))


def languages(df: DataFrame, key: str, label: str, parts: Column, model: Model) -> DataFrame:
    """``item_id, seg_no, lang, confidence, label_lang``: of each item (seg_no -1, its main language, the mean confidence of
    the parts in it) and of each part in another language than the main one. ``parts`` is an array of texts."""
    columns = ["item_id", "seg_no", "lang", "confidence", "label_lang"]
    broadcast = df.sparkSession.sparkContext.broadcast((model.languages, np.flatnonzero(model.slot >= 0), model.weights, model.bias))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, known, weights, bias = broadcast.value
        slot = np.full(1 << BITS, -1, np.int32)
        slot[known] = np.arange(len(known), dtype=np.int32)
        local = Model(names, slot, weights, bias)
        for batch in batches:
            forms: list[str] = []
            where: list[list[tuple[int, int]]] = []
            for ps in batch["parts"]:
                at = []
                for no, p in enumerate(ps if ps is not None else ()):
                    f = normal(p) if p else ""
                    if f:
                        at.append((no, len(forms)))
                        forms.append(f)
                where.append(at)
            conf = np.concatenate([confidences(local.scores(forms[k : k + BATCH])) for k in range(0, len(forms), BATCH)]) if forms else None
            rows = []
            for k, lab, at in zip(batch["k"].tolist(), batch["label"], where):
                if not at:
                    continue
                got = [(no, names[int(conf[i].argmax())], float(conf[i].max()), i) for no, i in at]
                main = main_language([(lang, len(forms[i])) for _, lang, _, i in got])
                known_label = label_language(lab if isinstance(lab, str) else None)
                own = [c for _, lang, c, _ in got if lang == main]
                rows.append((k, -1, main, sum(own) / len(own), known_label))
                rows += [(k, no, lang, c, known_label) for no, lang, c, _ in got if lang != main]
            yield pd.DataFrame(rows, columns=columns)

    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).alias("label"), parts.alias("parts"))
    return rows.mapInPandas(run, "item_id bigint, seg_no int, lang string, confidence double, label_lang string")

