"""Encoding of whole texts with a public byte-level BPE vocabulary, in DuckDB inside each partition.

Texts are cut into words by the vocabulary's pattern. The distinct words of a batch become token-position rows, one row per
byte at first. A recursive query joins neighbouring rows with the merge table and contracts, in each step, each word's
leftmost pair of minimum rank, until no word has a pair left. An ordered aggregation gives each word's ids, and each text is the
concatenation of its words. Words are cut first between bytes that stand next to each other in no merge: nothing is ever
contracted across such a place, so the parts, which come again in other words, are encoded by themselves.

Parts of more than ``SHORT_BYTES`` would need too many steps: for them a step contracts all occurrences of the minimum pair that
do not overlap (a contraction only makes pairs of higher rank, so the result is the same), the steps of one query are bounded,
and what is unfinished is carried into the next query, so a word of any length needs memory in proportion to its length only.
Words are remembered within a partition, up to ``REMEMBER`` of them.

Defined results: null and empty texts have the empty list; text that spells a special token is ordinary text; rows with a null
key are kept out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the public pattern of the byte_bpe_50k vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of the words of one query, steps of one query, and words remembered.
QUERY_BYTES, QUERY_STEPS, REMEMBER = 400_000, 24, 200_000
#: Bytes of a word up to which a step contracts one pair.
SHORT_BYTES = 64
#: Texts whose new words are encoded together.
TEXTS = 1_000


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def printable_bytes() -> list[str]:
    """The public rule that gives each byte a printable character: itself, or the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def load(path: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the 256 bytes, and the merge table as rows (left, right, rank, id of both)."""
    with open(path or default_path(), encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids = model["vocab"]
    rows = []
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        rows.append((ids[left], ids[right], rank, ids[left + right]))
    return np.array([ids[c] for c in printable_bytes()], np.int32), np.array(rows, np.int32)


_STEP = """
WITH RECURSIVE t(w, pos, id, step) AS (
  SELECT w, pos, id, 0 FROM rows
  UNION ALL
  SELECT w, CAST(row_number() OVER (PARTITION BY w ORDER BY pos) AS INTEGER), id, step
  FROM (
    SELECT w, pos, step + 1 AS step, CASE WHEN take THEN made ELSE id END AS id,
           coalesce(lag(take) OVER (PARTITION BY w ORDER BY pos), false) AS gone
    FROM (
      SELECT *, hit AND (pos - coalesce(max(CASE WHEN NOT hit THEN pos END)
                 OVER (PARTITION BY w ORDER BY pos ROWS UNBOUNDED PRECEDING), first_pos - 1)) % 2 = 1 AS take
      FROM (
        SELECT *, rank IS NOT NULL AND rank = least_rank AS hit FROM (
          SELECT p.*, m.rank, m.made, min(m.rank) OVER (PARTITION BY p.w) AS least_rank, min(p.pos) OVER (PARTITION BY p.w) AS first_pos
          FROM (SELECT w, pos, id, step, lead(id) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM t WHERE step < {steps}) p
          LEFT JOIN merges m ON m.l = p.id AND m.r = p.nxt)
        WHERE least_rank IS NOT NULL)))
  WHERE NOT gone)
SELECT w, max(step) AS step, array_agg(id ORDER BY pos) AS ids
FROM (SELECT *, max(step) OVER (PARTITION BY w) AS last FROM t) WHERE step = last GROUP BY w
"""


_SHORT = f"""
WITH RECURSIVE t(w, pos, id, step) AS (
  SELECT w, pos, id, 0 FROM rows
  UNION ALL
  SELECT t.w, CASE WHEN t.pos > b.at THEN t.pos - 1 ELSE t.pos END, CASE WHEN t.pos = b.at THEN b.made ELSE t.id END, t.step + 1
  FROM t JOIN (
    SELECT x.w, arg_min(x.pos, m.rank * {2 * SHORT_BYTES} + x.pos) AS at, arg_min(m.made, m.rank * {2 * SHORT_BYTES} + x.pos) AS made
    FROM t x JOIN t y ON y.w = x.w AND y.pos = x.pos + 1 JOIN merges m ON m.l = x.id AND m.r = y.id GROUP BY x.w) b ON b.w = t.w
  WHERE t.pos <> b.at + 1)
SELECT w, array_agg(id ORDER BY pos) AS ids FROM t JOIN (SELECT w, max(step) AS step FROM t GROUP BY w) USING (w, step) GROUP BY w
"""


def tied(byte_ids: np.ndarray, merges: np.ndarray) -> np.ndarray:
    """Whether a byte followed by another stands in any merge, as a table of both."""
    size = int(max(byte_ids.max(), merges.max(initial=0))) + 1
    first, last = np.zeros(size, np.int32), np.zeros(size, np.int32)
    first[byte_ids] = last[byte_ids] = np.arange(256)
    out = np.zeros((256, 256), bool)
    for left, right, _, made in merges.tolist():  # in the order of their ranks: both sides are known
        out[last[left], first[right]] = True
        first[made], last[made] = first[left], last[right]
    return out


class Encoder:
    """Encodes words with DuckDB; one per partition."""

    def __init__(self, byte_ids: np.ndarray, merges: np.ndarray, steps: int = QUERY_STEPS, size: int = QUERY_BYTES) -> None:
        self.byte_ids, self.steps, self.size = byte_ids, steps, size
        self.known: dict[str, list[int]] = {}
        self.parts: dict[bytes, list[int]] = {}
        self.tied = tied(byte_ids, merges)
        self.pattern = regex.compile(PATTERN)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "500MB"})
        table = pa.table({n: pa.array(merges[:, k]) for k, n in enumerate(("l", "r", "rank", "made"))})
        self.db.register("given_merges", table)
        self.db.execute("CREATE TABLE merges AS SELECT l, r, CAST(rank AS BIGINT) AS rank, made FROM given_merges")
        self.query = _STEP.format(steps=steps)

    def _rows(self, state: list) -> pa.Table:
        sizes = [len(s) for s in state]
        return pa.table({
            "w": pa.array(np.repeat(np.arange(len(state), dtype=np.int32), sizes)),
            "pos": pa.array(np.concatenate([np.arange(1, n + 1, dtype=np.int32) for n in sizes])),
            "id": pa.array(np.concatenate([np.asarray(s, np.int32) for s in state])),
        })

    def _run_short(self, words: list) -> list[list[int]]:
        """Contracts words of at most ``SHORT_BYTES``, given as ids, to the end."""
        self.db.register("rows", self._rows(words))
        out = self.db.sql(_SHORT).to_arrow_table()
        self.db.unregister("rows")
        got = dict(zip(out["w"].to_pylist(), out["ids"].to_pylist()))
        return [got[k] for k in range(len(words))]

    def _run(self, words: list) -> list[list[int]]:
        """Contracts words of any length, given as ids, to the end."""
        done: list[list[int]] = [[]] * len(words)
        todo = list(range(len(words)))
        state = words
        while todo:
            rows = self._rows(state)
            self.db.register("rows", rows)
            out = self.db.sql(self.query).to_arrow_table()
            self.db.unregister("rows")
            unfinished, next_state = [], []
            for w, step, ids in zip(out["w"].to_pylist(), out["step"].to_pylist(), out["ids"].to_pylist()):
                if step < self.steps:
                    done[todo[w]] = ids
                else:
                    unfinished.append(todo[w])
                    next_state.append(ids)
            todo, state = unfinished, next_state
        return done

    def cut(self, word: str) -> list[bytes]:
        """Parts of a word that no merge joins."""
        raw = word.encode()
        if len(raw) < 2:
            return [raw]
        b = np.frombuffer(raw, np.uint8)
        ends = (np.flatnonzero(~self.tied[b[:-1], b[1:]]) + 1).tolist()
        return [raw[x:y] for x, y in zip([0, *ends], [*ends, len(raw)])]

    def learn(self, words: list[str]) -> None:
        cut = {w: self.cut(w) for w in words}
        part: list[bytes] = []
        total, short = 0, True
        for w in sorted({x for xs in cut.values() for x in xs if x not in self.parts}, key=lambda w: (len(w), w)):
            n = len(w)
            if part and (total + n > self.size or short != (n <= SHORT_BYTES)):
                self._learn(part, short)
                part, total = [], 0
            short = n <= SHORT_BYTES
            part.append(w)
            total += n
        if part:
            self._learn(part, short)
        for w, xs in cut.items():
            self.known[w] = self.parts[xs[0]] if len(xs) == 1 else [i for x in xs for i in self.parts[x]]

    def _learn(self, parts: list[bytes], short: bool) -> None:
        start = [self.byte_ids[np.frombuffer(w, np.uint8)] for w in parts]
        self.parts.update(zip(parts, self._run_short(start) if short else self._run(start)))

    def words(self, texts: list[str | None]) -> list[list[str]]:
        """Words of each text; all of them are known afterwards."""
        cut = [self.pattern.findall(t) if t else [] for t in texts]
        new = {w for ws in cut for w in ws if w not in self.known}
        if len(self.known) + len(new) > REMEMBER:
            self.known.clear()
            self.parts.clear()
            new = {w for ws in cut for w in ws}
        if new:
            self.learn(list(new))
        return cut

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [[i for w in ws for i in self.known[w]] for ws in self.words(texts)]

    def count(self, texts: list[str | None]) -> list[int]:
        """Numbers of ids, without making them."""
        return [sum(len(self.known[w]) for w in ws) for ws in self.words(texts)]


def _encoded(df: DataFrame, text: str, made: str, shape: pa.DataType, method: str, path: str | None) -> DataFrame:
    """``df`` with the column ``made`` of ``Encoder.method`` in place of ``text``; all other columns pass through."""
    given = df.sparkSession.sparkContext.broadcast(load(path))
    others = [c for c in df.columns if c != text]
    ddl = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in others), f"{made} {'array<int>' if method == 'encode' else 'bigint'}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*given.value)
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                some = batch.slice(k, TEXTS)
                got = pa.array(getattr(encoder, method)(some.column(len(others)).to_pylist()), shape)
                yield pa.RecordBatch.from_arrays([*some.columns[: len(others)], got], names=[*others, made])

    return df.select(*others, text).mapInArrow(run, ddl)


def encoded(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """``key, ids`` of each row."""
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias(key), F.col(text).alias("t"))
    return _encoded(rows, "t", "ids", pa.list_(pa.int32()), "encode", path)


def counted(df: DataFrame, text: str, path: str | None = None) -> DataFrame:
    """``df`` with ``tokens``, the number of ids, in place of ``text``."""
    return _encoded(df, text, "tokens", pa.int64(), "count", path)
