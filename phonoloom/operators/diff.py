"""Differences between two copies of a table, found with invertible Bloom lookup tables.

Each copy is summarised, map side, into cells: a row of key k and digest h (a 64-bit hash of all compared fields)
is added to three cells of the bucket its key belongs to. Cells hold exact sums, not XORs, so a row that a copy
delivers twice is one item with a count of two. The cells of the copies are subtracted; what both hold vanishes,
and the cells of each bucket are peeled to give the (key, digest) items that differ. Only these keys are then
fetched from both copies and compared field by field. What is shuffled follows the number of differences,
not the number of rows.

The size of the tables comes from an estimate of the differences (an exact comparison of the keys in 1/64 of the
hash space, used for nothing else). A bucket that cannot be peeled all the same is compared exactly, key by
key, so the result is whole at any size.

Defined results: values differ if any code point does; two nulls are equal, null and empty are not; a null array
and an empty one differ. Rows with a null key identify nothing and are left out. A key that one copy holds with
several contents is represented by the content of the smallest digest. Empty copies are allowed; columns
that are not named are not read.
"""

from __future__ import annotations

import struct
from math import ceil

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonoloom.session import checkpointed

#: Cells of a bucket (a multiple of the three hash functions), cells for each expected difference, and the share
#: of the hash space that the estimate compares.
BUCKET_CELLS, CELLS_PER_ITEM, ESTIMATE_SHARE = 6_144, 1.6, 64
HASHES = 3
_LOW = 0xFFFFFFFF


def value_digest(df: DataFrame, fields: list[str]) -> Column:
    """A 64-bit hash of the fields that tells null from empty, at the top and inside arrays of texts."""
    parts: list[Column] = []
    for f in fields:
        if df.schema[f].dataType.typeName() == "array":
            parts += [F.size(F.col(f)).alias("n"), F.to_json(F.struct(F.col(f)), {"ignoreNullFields": "false"})]
        else:
            parts += [F.col(f).isNull(), F.col(f)]
    return F.xxhash64(*parts)


def _items(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("k"), value_digest(df, fields).alias("h"))


def _halves(c: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(c, 32), c.bitwiseAND(F.lit(_LOW))


def _cells(items: DataFrame, buckets: int, cells: int, sign: int) -> DataFrame:
    """Signed sums of each (bucket, cell); the aggregation combines map side before anything moves."""
    third = cells // HASHES
    at = [F.lit(j * third) + F.pmod(F.xxhash64(F.col("k"), F.col("h"), F.lit(j)), F.lit(third)).cast("int") for j in range(HASHES)]
    (khi, klo), (hhi, hlo) = _halves(F.col("k")), _halves(F.col("h"))
    check = F.shiftrightunsigned(F.xxhash64(F.col("h"), F.col("k")), 32)
    rows = items.select(
        F.pmod(F.xxhash64("k"), F.lit(buckets)).cast("int").alias("bucket"),
        khi.alias("khi"), klo.alias("klo"), hhi.alias("hhi"), hlo.alias("hlo"), check.alias("c"),
        F.explode(F.array(*at)).alias("cell"),
    )
    s = lambda c: (F.sum(c) * F.lit(sign)).alias(c)
    return rows.groupBy("bucket", "cell").agg((F.count("*") * F.lit(sign)).alias("n"), *(s(c) for c in ("khi", "klo", "hhi", "hlo", "c")))


def _hash_long(value: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(struct.pack("<q", value), seed & 0xFFFFFFFFFFFFFFFF)


def _hash_int(value: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(struct.pack("<i", value), seed)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def peel(table: dict[int, list[int]], third: int) -> tuple[list[tuple[int, int, int]], bool]:
    """Items (key, digest, signed count) of a subtracted table of cells, and whether nothing is left.

    A cell holds one item if its sums divided by its count give a key and a digest whose check value and place agree.
    """
    found: list[tuple[int, int, int]] = []
    todo = list(table)
    while todo:
        at = todo.pop()
        cell = table.get(at)
        if cell is None:
            continue
        n = cell[0]
        if n == 0 or any(v % n for v in cell[1:]):
            continue
        khi, klo, hhi, hlo, check = (v // n for v in cell[1:])
        if not all(0 <= v <= _LOW for v in (khi, klo, hhi, hlo, check)):
            continue
        k, h = _signed(khi << 32 | klo), _signed(hhi << 32 | hlo)
        if _hash_long(k, _hash_long(h, 42)) >> 32 != check:
            continue
        seed = _hash_long(h, _hash_long(k, 42))
        places = [j * third + _signed(_hash_int(j, seed)) % third for j in range(HASHES)]
        if at not in places:
            continue
        found.append((k, h, n))
        for p in places:
            other = table.setdefault(p, [0] * 6)
            for i, v in enumerate((n, khi * n, klo * n, hhi * n, hlo * n, check * n)):
                other[i] -= v
            if any(other):
                todo.append(p)
            else:
                del table[p]
    return found, not table


def _peel_bucket(third: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["bucket"].iloc[0])
        names = ["n", "khi", "klo", "hhi", "hlo", "c"]
        table = {int(r[0]): [int(v) for v in r[1:]] for r in pdf[["cell", *names]].itertuples(index=False)}
        found, whole = peel(table, third)
        rows = [(bucket, k, True) for k in dict.fromkeys(k for k, _, _ in found)]
        if not whole:
            rows.append((bucket, None, False))
        out = pd.DataFrame(rows, columns=["bucket", "k", "peeled"])
        return out.astype({"k": "Int64"})

    return run


def estimate_differences(a: DataFrame, b: DataFrame) -> int:
    """About how many (key, digest) items only one copy holds."""
    part = lambda d, side: d.filter(F.pmod(F.xxhash64(F.col("k"), F.lit("estimate")), F.lit(ESTIMATE_SHARE)) == 0).withColumn("side", F.lit(side))
    both = part(a, 1).unionByName(part(b, -1)).groupBy("k", "h").agg(F.sum("side").alias("s"))
    return both.filter("s <> 0").count() * ESTIMATE_SHARE


def differing_keys(left: DataFrame, right: DataFrame, key: str, fields: list[str], expected: int | None = None) -> DataFrame:
    """Column ``k``: every key whose rows differ between the copies (and possibly some whose rows only differ in
    how often they were delivered)."""
    a, b = _items(left, key, fields), _items(right, key, fields)
    wanted = max(expected if expected is not None else estimate_differences(a, b), 1) * CELLS_PER_ITEM
    # Spread over at least a dozen buckets, so that peeling has tasks to run on; a bucket's own spread needs slack.
    buckets = max(12, ceil(wanted / BUCKET_CELLS))
    cells = HASHES * ceil(max(wanted / buckets * 1.25, 96) / HASHES)
    diff = _cells(a, buckets, cells, 1).unionByName(_cells(b, buckets, cells, -1))
    names = ["n", "khi", "klo", "hhi", "hlo", "c"]
    diff = diff.groupBy("bucket", "cell").agg(*(F.sum(c).alias(c) for c in names))
    diff = diff.filter(" or ".join(f"{c} <> 0" for c in names))
    peeled = checkpointed(diff.groupBy("bucket").applyInPandas(_peel_bucket(cells // HASHES), "bucket int, k bigint, peeled boolean"))
    keys = peeled.filter("peeled").select("k")
    failed = peeled.filter("not peeled").select("bucket").distinct()
    if not failed.isEmpty():
        inside = lambda d, side: d.withColumn("bucket", F.pmod(F.xxhash64("k"), F.lit(buckets)).cast("int")).join(failed, "bucket", "left_semi").select("k", "h", F.lit(side).alias("side"))
        exact = inside(a, 1).unionByName(inside(b, -1)).groupBy("k", "h").agg(F.bool_or(F.col("side") == 1).alias("l"), F.bool_or(F.col("side") == -1).alias("r"))
        keys = keys.unionByName(exact.filter("not (l and r)").select("k"))
    return keys.distinct()


def _fetched(df: DataFrame, keys: DataFrame, key: str, fields: list[str], tag: str) -> DataFrame:
    rows = df.select(F.col(key).cast("bigint").alias("k"), F.struct(*fields).alias(tag), value_digest(df, fields).alias("h"))
    rows = rows.join(keys, "k", "left_semi")
    return rows.groupBy("k").agg(F.min_by(tag, "h").alias(tag))


def table_differences(
    left: DataFrame, right: DataFrame, key: str, fields: list[str], lists: list[str],
    left_name: str, right_name: str, item: str | None = "text", expected: int | None = None,
) -> DataFrame:
    """``key, kind, position, left_value, right_value`` of every difference.

    ``kind`` is ``missing_in_<name>`` (position -1), the name of a scalar field (position -1), or the name of a list
    field: a row for each position at which the items differ or only one side has one, and one row at -1 if
    just one side's list is null. ``item`` names the compared member of a list of structs.
    """
    both = fields + lists
    keys = differing_keys(left, right, key, both, expected)
    pair = _fetched(left, keys, key, both, "l").join(_fetched(right, keys, key, both, "r"), "k", "full_outer")
    text = lambda c: c.cast("string")
    hit = lambda kind, pos, lv, rv: F.struct(F.lit(kind).alias("kind"), pos.cast("int").alias("position"), text(lv).alias("left_value"), text(rv).alias("right_value"))
    none, whole = F.lit(None).cast("string"), F.lit(-1)
    tests = [
        F.when(F.col("r").isNull(), F.array(hit(f"missing_in_{right_name}", whole, none, none))),
        F.when(F.col("l").isNull(), F.array(hit(f"missing_in_{left_name}", whole, none, none))),
    ]
    here = F.col("l").isNotNull() & F.col("r").isNotNull()
    for f in fields:
        a, b = F.col(f"l.{f}"), F.col(f"r.{f}")
        tests.append(F.when(here & ~a.eqNullSafe(b), F.array(hit(f, whole, a, b))))
    for f in lists:
        a, b = F.col(f"l.{f}"), F.col(f"r.{f}")
        longest = F.greatest(F.size(a), F.size(b))
        at = lambda c, i: F.get(c, i)[item] if item else F.get(c, i)
        rows = F.transform(
            F.filter(
                F.when(longest > 0, F.sequence(F.lit(0), longest - 1)).otherwise(F.array().cast("array<int>")),
                lambda i: ((i < F.size(a)) != (i < F.size(b))) | ~at(a, i).eqNullSafe(at(b, i)),
            ),
            lambda i: hit(f, i, at(a, i), at(b, i)),
        )
        tests.append(F.when(here & a.isNotNull() & b.isNotNull(), rows))
        tests.append(F.when(here & (a.isNull() != b.isNull()), F.array(hit(f, whole, *(F.to_json(x, {"ignoreNullFields": "false"}) for x in (a, b))))))
    shape = "array<struct<kind:string,position:int,left_value:string,right_value:string>>"
    found = F.flatten(F.array(*(F.coalesce(t.cast(shape), F.array().cast(shape)) for t in tests)))
    return pair.select(F.col("k").alias(key), F.inline(found))
