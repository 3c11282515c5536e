"""Subject areas of documents, from averaged word and subword embeddings with independent logistic outputs.

A sentence is the weighted average of the embeddings of its features: its words and the beginnings of longer words (in scripts
without spaces: pairs of characters). One logistic output for each subject reads it. Features are hashed to ``SLOTS`` rows, so the
model has a bound that does not depend on the corpus. A feature's weight falls to zero where it stands in ``COMMON`` or more of the
documents of some language, and grows with the documents that support it; both are counted over all documents.

Training has one first stage on the labelled samples (all rows, at most ``SAMPLE_ROWS``) and ``STAGES`` stages on all documents
and the samples. In a stage the model before names the subjects of each document (at least ``LEAST_SHARE`` of its distinct
sentences speak about them), and every sentence of the document is taught them: a word that stands in documents of a subject
comes out sure, a word that stands everywhere comes out at the subject's share of all documents, which is no evidence. Every
step is synchronous: each partition sums the gradients of its documents, the sums are added by ranges of features, and one Adam
step follows. A step reads one of ``SLICES`` slices of the documents, cut by the hash of their keys; a stage reads all of them
``STEPS / SLICES`` times. The result depends on partitioning only through the order of float additions.

A document has a subject if at least ``LEAST_SHARE`` of its distinct sentences speak about it. Defined results: null, empty
and wordless texts have no subject; a sentence that comes twice in a document counts once; rows with a null key are left out.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonoloom.llm import sentences as sent
from phonoloom.llm.forms import bare
from phonoloom.llm.langid import label_language
from phonoloom.session import stored

SAMPLE_ROWS, LEAST_SHARE = 5_000, 0.25
#: Rows of the embedding table, and its width.
SLOTS, DIM = 1 << 20, 8
#: Documents of a language that a feature may stand in before it says nothing; documents by which that share is smoothed;
#: documents at which half of a feature's weight is there.
COMMON, SMOOTHING, SUPPORT = 0.3, 20, 10
#: Steps and rate on the samples, and for each stage on documents; how much the samples count beside the documents.
FIRST_STEPS, FIRST_RATE = 40, 0.1
STAGES, STEPS, SLICES, RATE, SAMPLE_WEIGHT = 4, 16, 8, 0.15, 0.05
#: Letters of the beginning that is a longer word's subword.
SUBWORD = 5
#: Ranges of features whose gradients are added apart from each other.
RANGES = 16
#: Bytes of gradients up to which the driver adds those of all partitions itself; more are added by ranges on workers first.
DRIVER_BYTES = 32 << 20
NO_SUBJECT = "none"

_RUN = regex.compile(r"[\p{L}\p{M}]+")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]")
_SCRIPT_RUN = regex.compile(r"[\p{Katakana}ー]+|[\p{Han}々]+|\p{Hiragana}+|[^\p{Han}\p{Hiragana}\p{Katakana}ー]+")
_KATAKANA = regex.compile(r"[\p{Katakana}ー]")
_GAP = regex.compile(r"(?<=[\p{Han}\p{Hiragana}\p{Katakana}ー]) (?=[\p{Han}\p{Hiragana}\p{Katakana}ー])")


def letters(text: str) -> str:
    """Runs of letters without case, accents and odd characters."""
    return " ".join(_RUN.findall(bare(text)))


_word_letters = sent.remembered(letters)


def tokens(form: str) -> list[str]:
    """Words of a form of letters; in scripts without spaces runs of katakana and pairs of other characters."""
    out: list[str] = []
    for w in form.split():
        if w.isascii() or not _UNSPACED.search(w):
            out.append(w)
            continue
        for run in _SCRIPT_RUN.findall(unicodedata.normalize("NFC", w)):
            if len(run) > 1 and _UNSPACED.match(run) and not _KATAKANA.match(run):
                out += [run[i : i + 2] for i in range(len(run) - 1)]
            else:
                out.append(run)
    return out


def features(token: str) -> list[str]:
    """A token and, if it is longer than a subword, its beginning."""
    return [token] if len(token) <= SUBWORD else [token, f"<{token[:SUBWORD]}"]


def document_sentences(text: str, model: sent.Model) -> list[str]:
    """Forms of the distinct sentences of a text; a line ends one."""
    out: dict[str, None] = {}
    for line in dict.fromkeys(text.splitlines()):  # a line that comes again has no new sentence
        words = sent.split_words(line)
        dense = not line.isascii() and _UNSPACED.search(line)
        for a, b in sent.segment(model, words):
            some = words[a : b + 1]
            form = letters(_GAP.sub("", " ".join(some))) if dense else " ".join(filter(None, map(_word_letters, some)))
            if form:
                out[form] = None
    return list(out)


class Slotter:
    """Slots of the features of sentences; the slots of ``LIMIT`` tokens are remembered."""

    LIMIT = 200_000

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}

    def __call__(self, form: str) -> bytes:
        out = []
        for t in tokens(form):
            if (b := self.known.get(t)) is None:
                if len(self.known) >= self.LIMIT:
                    self.known.clear()
                b = self.known[t] = np.array([crc32(f.encode()) % SLOTS for f in features(t)], np.int32).tobytes()
            out.append(b)
        return b"".join(out)


class Rows:
    """Sentences as weighted features: ``at`` (rows of the table), ``weight`` (sums to 1 in a sentence) and sentence lengths."""

    def __init__(self, slots: np.ndarray, lengths: np.ndarray, known: np.ndarray, weight: np.ndarray) -> None:
        owner = np.repeat(np.arange(len(lengths)), lengths)
        at = np.searchsorted(known, slots)
        hit = (known[np.minimum(at, len(known) - 1)] == slots) if len(known) else np.zeros(len(slots), bool)
        at, owner = at[hit], owner[hit]
        w = weight[at].astype(np.float32)
        total = np.bincount(owner, w, minlength=len(lengths))
        self.n, self.at, self.owner = len(lengths), at, owner
        self.weight = (w / np.maximum(total, 1e-9)[owner]).astype(np.float32)[:, None]
        self.starts = np.flatnonzero(np.diff(owner, prepend=-1))

    def average(self, table: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, table.shape[1]), np.float32)
        if len(self.at):
            out[self.owner[self.starts]] = np.add.reduceat(table[self.at] * self.weight, self.starts, axis=0)
        return out

    def backward(self, to_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the table that are used, in order, and their gradients."""
        order = np.argsort(self.at, kind="stable")
        at = self.at[order]
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        if not len(starts):
            return at, np.zeros((0, to_rows.shape[1]), np.float32)
        return at[starts], np.add.reduceat(to_rows[self.owner[order]] * self.weight[order], starts, axis=0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Embedded:
    """Embeddings of the known slots, weights of their features, and the logistic outputs."""

    subjects: list[str]
    known: np.ndarray
    weight: np.ndarray
    table: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, subjects: Sequence[str], known: np.ndarray, weight: np.ndarray, seed: int = 7) -> Embedded:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.1, (len(known), DIM)).astype(np.float32)
        out = rng.normal(0, 0.5, (DIM, len(subjects))).astype(np.float32)
        return cls(list(subjects), known, weight, table, out, np.full(len(subjects), -2.0, np.float32))

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.out, self.bias]

    def folded(self) -> np.ndarray:
        return self.table @ self.out

    def logits(self, lines: Sequence[str]) -> np.ndarray:
        """Of sentences in the form of ``letters``."""
        slotter = Slotter()
        parts = [np.frombuffer(slotter(s), np.int32) for s in lines]
        rows = Rows(np.concatenate([*parts, np.zeros(0, np.int32)]), np.array([len(p) for p in parts], np.int64), self.known, self.weight)
        return rows.average(self.folded()) + self.bias


def gradient(model: Embedded, rows: Rows, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Used rows of the table, and summed gradients of them, of the outputs and of the biases."""
    mean = rows.average(model.table)
    error = (sigmoid(mean @ model.out + model.bias) - target).astype(np.float32)
    used, first = rows.backward(error @ model.out.T)
    return used, [first, mean.T @ error, error.sum(0)]


class Adam:
    def __init__(self, parameters: list[np.ndarray]) -> None:
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
        self.step = 0

    def take(self, parameters: list[np.ndarray], gradients: list[np.ndarray], rate: float) -> None:
        self.step += 1
        for p, (m1, m2), g in zip(parameters, self.moments, gradients):
            m1 *= 0.9
            m1 += 0.1 * g
            m2 *= 0.99
            m2 += 0.01 * g * g
            p -= rate * (m1 / (1 - 0.9**self.step)) / (np.sqrt(m2 / (1 - 0.99**self.step)) + 1e-9)


def shares(rows: Rows, folded: np.ndarray, bias: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Share of the sentences of each document that speak about each subject (a probability above a half); ``sizes`` are sentences."""
    speaks = (rows.average(folded) + bias > 0).astype(np.float64)
    total = np.concatenate([np.zeros((1, speaks.shape[1])), np.cumsum(speaks, axis=0)])
    ends = np.cumsum(sizes)
    return (total[ends] - total[ends - sizes]) / np.maximum(sizes, 1)[:, None]


def unpacked(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all sentences, their lengths, and the sentences of each document."""
    lengths = np.frombuffer(b"".join(batch["lengths"]), np.int32).astype(np.int64)
    return np.frombuffer(b"".join(batch["slots"]), np.int32), lengths, np.array([len(x) // 4 for x in batch["lengths"]], np.int64)


def split(df: DataFrame, key: str, lang: str, text: str, model: sent.Model) -> DataFrame:
    """``k, lang, lengths, slots, slice`` of each document, stored for training and scoring: the language that its label names
    ('' for none), and the slots of the features of its distinct sentences as 32-bit numbers, one sentence after another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slotter = Slotter()
        for batch in batches:
            found = [[slotter(s) for s in document_sentences(t, model)] if t else [] for t in batch["t"]]
            yield pd.DataFrame({
                "k": batch["k"],
                "lang": [label_language(x) or "" for x in batch["lang"]],
                "lengths": [np.array([len(s) // 4 for s in f], np.int32).tobytes() for f in found],
                "slots": [b"".join(f) for f in found],
            })

    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("k"), F.col(lang).alias("lang"), F.col(text).alias("t"))
    made = rows.mapInPandas(run, "k bigint, lang string, lengths binary, slots binary")
    return stored(made.withColumn("slice", F.pmod(F.xxhash64("k"), F.lit(SLICES)).cast("int")), "slice")


def feature_weights(documents: DataFrame, samples: list[tuple[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Slots that carry weight, in order, and their weights: at most ``SLOTS``, from counts over all documents and the samples
    (language, slots). Workers count before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count: dict[str, np.ndarray] = {}
        held = 0
        for batch in batches:
            for lang, some in batch.groupby("lang"):
                slots = [np.unique(np.frombuffer(s, np.int32)) for s in some["slots"] if s]
                total = count.get(lang)
                if total is None:
                    total = count[lang] = np.zeros(SLOTS + 1, np.int64)
                    held += 1
                total[SLOTS] += len(slots)
                if slots:
                    total[:SLOTS] += np.bincount(np.concatenate(slots), minlength=SLOTS)
            if held > 8:  # labels may name many languages
                yield from emit(count)
                held = 0
        yield from emit(count)

    def emit(count: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        for lang, total in count.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "slot": at.astype(np.int32), "n": total[at]})
        count.clear()

    counts = documents.select("lang", "slots").mapInPandas(run, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    spark = documents.sparkSession
    extra = [(lang, int(s), 1) for lang, slots in samples for s in [*np.unique(slots), SLOTS]]
    counts = counts.unionByName(spark.createDataFrame(extra, counts.schema)).groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    whole = F.max_by(F.col("n"), F.when(F.col("slot") == SLOTS, 1).otherwise(0)).alias("documents")
    # One row for each language that a label names, then one for each slot at most.
    sizes = counts.groupBy("lang").agg(whole)
    part = F.when(F.col("lang") == "", 0.0).otherwise(F.col("n") / (F.col("documents") + SMOOTHING))
    per = counts.filter(F.col("slot") < SLOTS).join(sizes, "lang").groupBy("slot").agg(F.max(part).alias("share"), F.sum("n").alias("n"))
    got = per.filter(F.col("share") < COMMON).toPandas().sort_values("slot")
    share, n = got["share"].to_numpy(float), got["n"].to_numpy(float)
    weight = np.clip(np.log(COMMON / np.maximum(share, 1e-9)), 0, 1) * n / (n + SUPPORT)
    return got["slot"].to_numpy(np.int32), weight.astype(np.float32)


def _summed(part: DataFrame, model: Embedded, before: tuple[np.ndarray, np.ndarray], shared) -> tuple[int, list[np.ndarray]]:
    """Sentences of a slice and their summed gradients."""
    context = part.sparkSession.sparkContext
    given = context.broadcast(model.parameters)
    per_range = -(-max(len(model.known), 1) // RANGES)
    shape = "range int, n bigint, at binary, g binary"

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        subjects, known, weight, folded, bias = shared.value
        local = Embedded(subjects, known, weight, *given.value)
        total, n = [np.zeros_like(p) for p in local.parameters], 0
        for batch in batches:
            slots, lengths, sizes = unpacked(batch)
            rows = Rows(slots, lengths, known, weight)
            target = np.repeat(shares(rows, folded, bias, sizes) >= LEAST_SHARE, sizes, axis=0).astype(np.float32)
            used, (first, out, b) = gradient(local, rows, target)
            total[0][used] += first
            total[1] += out
            total[2] += b
            n += rows.n
        used = np.flatnonzero(total[0].any(1))
        made = [(-1, n, b"", np.concatenate([total[1].ravel(), total[2]]).astype(np.float32).tobytes())]
        for r, at in ((r, used[used // per_range == r]) for r in np.unique(used // per_range)):
            made.append((int(r), 0, at.astype(np.int32).tobytes(), total[0][at].tobytes()))
        yield pd.DataFrame(made, columns=["range", "n", "at", "g"])

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            for r, n, at, g in batch.itertuples(index=False):
                values = np.frombuffer(g, np.float32)
                got = held.get(r)
                if got is None:
                    got = held[r] = [0, np.zeros(len(values)) if r < 0 else np.zeros((per_range, DIM), np.float32)]
                got[0] += n
                if r < 0:
                    got[1] += values
                else:
                    got[1][np.frombuffer(at, np.int32) - r * per_range] += values.reshape(-1, DIM)
        made = []
        for r, (n, g) in held.items():
            used = np.flatnonzero(g.any(1)) if r >= 0 else slice(None)
            at = (used + r * per_range).astype(np.int32).tobytes() if r >= 0 else b""
            made.append((r, n, at, g[used].astype(np.float32).tobytes()))
        yield pd.DataFrame(made, columns=["range", "n", "at", "g"])

    sums = part.select("lengths", "slots").mapInPandas(add, shape)
    if part.rdd.getNumPartitions() * model.table.nbytes > DRIVER_BYTES:
        # One row for each range of features comes back: together as large as the model.
        sums = sums.repartition(RANGES, "range").mapInPandas(merge, shape)
    got = sums.collect()
    given.destroy()
    total, n = [np.zeros_like(p) for p in model.parameters], 0
    for r in got:
        values = np.frombuffer(bytes(r["g"]), np.float32)
        if r["range"] < 0:
            n += r["n"]
            total[1] += values[: model.out.size].reshape(model.out.shape)
            total[2] += values[model.out.size :]
        else:
            total[0][np.frombuffer(bytes(r["at"]), np.int32)] += values.reshape(-1, DIM)
    return n, total


def train(documents: DataFrame, samples: DataFrame, units: sent.Model) -> Embedded:
    """The model, from ``samples`` (sample_id, subject, lang, text) and all documents as ``split`` gives them."""
    rows = samples.filter(F.col("text").isNotNull() & F.col("subject").isNotNull()).select("sample_id", "subject", "lang", "text").orderBy("sample_id").limit(SAMPLE_ROWS).collect()
    subjects = sorted({r["subject"] for r in rows} - {NO_SUBJECT})
    slotter = Slotter()
    labelled = [(r, np.frombuffer(slotter(s), np.int32)) for r in rows for s in document_sentences(r["text"], units)]
    whole: dict[int, list[np.ndarray]] = {}
    for r, slots in labelled:
        whole.setdefault(r["sample_id"], []).append(slots)
    language = {r["sample_id"]: label_language(r["lang"]) or "" for r in rows}
    known, weight = feature_weights(documents, [(language[k], np.concatenate(v)) for k, v in whole.items()])
    target = np.array([[float(r["subject"] == s) for s in subjects] for r, _ in labelled], np.float32).reshape(len(labelled), len(subjects))
    sample_rows = Rows(np.concatenate([*(x for _, x in labelled), np.zeros(0, np.int32)]), np.array([len(x) for _, x in labelled], np.int64), known, weight)

    def of_samples(model: Embedded) -> list[np.ndarray]:
        used, gradients = gradient(model, sample_rows, target)
        first = np.zeros_like(model.table)
        first[used] = gradients[0]
        return [g / max(sample_rows.n, 1) for g in (first, *gradients[1:])]

    model = Embedded.fresh(subjects, known, weight)
    adam = Adam(model.parameters)
    for _ in range(FIRST_STEPS):
        adam.take(model.parameters, of_samples(model), FIRST_RATE)
    slices = [documents.filter(F.col("slice") == k) for k in range(SLICES)]
    context = documents.sparkSession.sparkContext
    for _ in range(STAGES):
        before = model.folded(), model.bias.copy()
        shared = context.broadcast((subjects, known, weight, *before))
        model = Embedded.fresh(subjects, known, weight)
        adam = Adam(model.parameters)
        for step in range(STEPS):
            n, total = _summed(slices[step % SLICES], model, before, shared)
            adam.take(model.parameters, [g / max(n, 1) + SAMPLE_WEIGHT * s for g, s in zip(total, of_samples(model))], RATE)
        shared.destroy()
    return model


def subject_shares(documents: DataFrame, model: Embedded) -> DataFrame:
    """``doc_id, subject, share, n_sentences`` of each document of ``split`` and subject that any of its sentences speaks about."""
    given = documents.sparkSession.sparkContext.broadcast((model.subjects, model.known, model.weight, model.folded(), model.bias))
    columns = ["doc_id", "subject", "share", "n_sentences"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, known, weight, folded, bias = given.value
        for batch in batches:
            slots, lengths, sizes = unpacked(batch)
            share = shares(Rows(slots, lengths, known, weight), folded, bias, sizes)
            doc, subject = np.nonzero(share)
            keys = batch["k"].to_numpy()
            yield pd.DataFrame({"doc_id": keys[doc], "subject": np.array(names, object)[subject], "share": share[doc, subject], "n_sentences": sizes[doc].astype(np.int32)}, columns=columns)

    return documents.select("k", "lengths", "slots").mapInPandas(run, "doc_id bigint, subject string, share double, n_sentences int")
