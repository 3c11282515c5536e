from phonoloom.operators import diff

SHAPE = "id long, path string, language string, segments array<struct<text:string>>, k string"


def rows(spark, data):
    return spark.createDataFrame([(*r, "clash") for r in data], SHAPE)


def found(a, b, expected=None):
    out = diff.table_differences(a, b, "id", ["path", "language"], ["segments"], "left", "right", expected=expected)
    return sorted((r.id, r.kind, r.position) for r in out.collect())


def test_every_kind(spark):
    a = rows(spark, [(1, "p", "en", [("x",)]), (1, "p", "en", [("x",)]), (2, None, "", [("x",), (None,)]), (3, "p", "en", None), (4, "p", "en", []), (5, "p", "en", [("a",), ("b",)]), (None, "p", "en", []), (7, "p", "en", [])])
    b = rows(spark, [(1, "p", "en", [("x",)]), (2, "", None, [("x",), ("",)]), (3, "p", "en", []), (4, "p", "en", [("n",)]), (5, "p", "en", [("a",), ("c",), ("d",)]), (6, "p", "en", []), (7, "p", "en", [])])
    want = [(2, "language", -1), (2, "path", -1), (2, "segments", 1), (3, "segments", -1), (4, "segments", 0), (5, "segments", 1), (5, "segments", 2), (6, "missing_in_left", -1)]
    assert found(a, b) == want
    assert found(a, a) == []
    assert found(a, a.limit(0)) == sorted((i, "missing_in_right", -1) for i in (1, 2, 3, 4, 5, 7))


def test_unpeelable_buckets_are_compared_exactly(spark):
    a = rows(spark, [(i, "p", "en", []) for i in range(3000)])
    b = rows(spark, [(i, "p" if i % 2 else "q", "en", []) for i in range(3000)])
    assert len(found(a, b, expected=1)) == 1500


def test_peel_recovers_what_differs():
    third, table = 50, {}
    items = [(k, k * 7919 - 5, 1 if k % 2 else -2) for k in range(-20, 40)]
    for k, h, n in items:
        seed = diff._hash_long(h, diff._hash_long(k, 42))
        check = diff._hash_long(k, diff._hash_long(h, 42)) >> 32
        half = lambda v: ((v & (1 << 64) - 1) >> 32, v & 0xFFFFFFFF)
        for j in range(3):
            cell = table.setdefault(j * third + diff._signed(diff._hash_int(j, seed)) % third, [0] * 6)
            for i, v in enumerate((1, *half(k), *half(h), check)):
                cell[i] += n * v
    got, whole = diff.peel(table, third)
    assert whole and sorted(got) == sorted(items)
