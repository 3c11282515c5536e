import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from phonoloom.operators import intervals as iv


def brute(rows):
    gaps, periods = [], []
    reach = None
    for s, e in sorted(rows):
        if reach is None or s > reach:
            if reach is not None:
                gaps.append((reach, s))
            periods.append([s, e])
        periods[-1][1] = max(periods[-1][1], e)
        reach = e if reach is None else max(reach, e)
    return gaps, [tuple(p) for p in periods]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 15)), max_size=40))
def test_map_equals_brute_force(rows):
    m = iv.IntervalMap()
    for s, n in rows:
        m.insert(s, s + n)
    gaps, periods = brute([(s, s + n) for s, n in rows])
    assert list(m.periods()) == periods
    assert m.gaps == [b - a for a, b in gaps]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 80), st.integers(0, 9)), max_size=8), max_size=8))
def test_runs_equal_brute_force(runs):
    m = iv.IntervalMap()
    for run in runs:
        m.insert_run(*iv.disjoint(sorted((s, s + n) for s, n in run)))
    gaps, periods = brute([(s, s + n) for run in runs for s, n in run])
    assert list(m.periods()) == periods and m.gaps == [b - a for a, b in gaps]


def test_distributed_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, s, s + rng.choice([0, 50, 900, 700_000])) for k in (1, 2) for s in (rng.randrange(0, 5_000_000) for _ in range(300))]
    rows += rows[:40] + [(3, 5, 9)]
    df = spark.createDataFrame(rows, "entity long, start_ms long, end_ms long").repartition(5)
    gaps = {tuple(r) for r in iv.gaps(df).collect()}
    periods = {tuple(r) for r in iv.periods(df).drop("period_no").collect()}
    want_gaps, want_periods = set(), set()
    for k in {r[0] for r in rows}:
        g, p = brute([r[1:] for r in rows if r[0] == k])
        want_gaps |= {(k, *x) for x in g}
        want_periods |= {(k, *x) for x in p}
    assert gaps == want_gaps and periods == want_periods


def test_words_dirty_times(spark):
    nan, inf = float("nan"), float("inf")
    words = [("a", 1.0, 2.0), ("b", None, 3.0), ("c", nan, 3.0), ("d", -1.0, 9.0), ("e", 5.0, 5.0), ("f", 2.2504, 3.0), ("g", 1.0, inf), ("h", 1e300, 1e301), None]
    df = spark.createDataFrame([(1, words, "x"), (None, words, "x"), (2, None, "x"), (3, [], "x")], "rec_id long, w array<struct<word:string,start:double,end:double>>, entity string")
    got = iv.word_intervals(df, "rec_id", "w")
    assert {tuple(r) for r in got.collect()} == {(1, 1000, 2000), (1, 2250, 3000)}
    assert [tuple(r) for r in iv.gaps(got, 250).collect()] == [(1, 2000, 2250)]
    spans = iv.word_spans(df, "rec_id", "w")
    assert [tuple(r) for r in iv.gaps(spans, 250).collect()] == [(1, 2000, 2250)]
    assert sorted(tuple(r) for r in iv.periods(spans).drop("period_no").collect()) == [(1, 1000, 2000), (1, 2250, 3000)]
    assert iv.gaps(got, 251).count() == 0
    assert iv.gaps(got.filter(F.lit(False))).count() == 0 and iv.periods(got.filter(F.lit(False))).count() == 0


def test_stream_state(spark, tmp_path):
    from phonoloom.streaming.live import growing_periods

    spark.createDataFrame(pd.DataFrame({"entity": [1, 1, 1], "start_ms": [0, 5, 30], "end_ms": [10, 20, 40]})).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("entity long, start_ms long, end_ms long").parquet(str(tmp_path / "in"))
    q = growing_periods(stream).writeStream.outputMode("update").format("memory").queryName("grown").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    r = spark.table("grown").collect()[-1]
    assert (list(r.starts), list(r.ends)) == ([0, 30], [20, 40])
