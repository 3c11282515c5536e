import json
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from phonoloom.operators import models, signal, transcript
from phonoloom.plans import pipelines


def tone(seconds, rate=8_000, hz=300.0):
    return signal.write_wav((np.sin(np.arange(int(seconds * rate)) * 2 * np.pi * hz / rate) * 0.5)[:, None], rate)


def put(root, files):
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data if isinstance(data, bytes) else data.encode() if isinstance(data, str) else json.dumps(data).encode())


def words(*rows):
    return {"word_segments": [{"word": w, "start": s, "end": e} for w, s, e in rows]}


def test_split_recordings(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    put(root, {
        "d/a.wav": tone(70), "d/a.json": words(*[(f"W{i}.", i * 6.0, i * 6.0 + 5) for i in range(11)], ("tail.", 69.0, 69.1), ("late.", 120.0, 121.0)),
        "d/b.json": words(("x.", 0.0, 1.0)), "d/c.wav": b"broken", "d/c.json": words(("x.", 0.0, 1.0)),
        "e.wav": tone(2), "e.json": {"other": 1}, "f.wav": tone(2), "f.json": {"word_segments": []}, "g.wav": tone(2), "g.json": "{bad",
    })
    kept = {}
    for turn in (1, 2):  # the second run gives the same files
        rows = {Path(r.path).stem: r for r in pipelines.split_recordings(spark, str(root), str(out), seed=3).collect()}
        assert {k: r.problem for k, r in rows.items()} == {"a": None, "b": "no recording", "c": None, "e": "no word_segments", "f": "empty word_segments", "g": "invalid json"}
        assert rows["c"].errors == 1 and rows["c"].kept == 0
        a = rows["a"]
        assert a.chunks == a.kept + a.short + a.invalid and a.invalid == 1 and a.kept >= 3
        texts = {int(p.stem.split("_")[-1]): p for p in (out / "d").glob("a_chunk_*.txt")}
        assert len(texts) == a.kept == len(list((out / "d").glob("a_chunk_*.wav"))) and not list(out.rglob("*.part-*"))
        assert " ".join(texts[k].read_text().strip() for k in sorted(texts)).split()[:11] == [f"W{i}." for i in range(11)]
        for k in texts:
            samples, rate, _ = signal.read_wav((out / "d" / f"a_chunk_{k}.wav").read_bytes())
            assert 0.2 <= len(samples) / rate <= 30
        kept[turn] = {p.name: p.read_bytes() for p in out.rglob("*.*")}
    assert kept[1] == kept[2]


def test_targets(spark):
    df = spark.createDataFrame([("a", 200), ("b", 200), (None, 3), ("c", None), ("a", 200)], "k string, n int")
    got = [r.t for r in df.select(transcript.targets(F.col("k"), F.col("n"), seed=1).alias("t")).collect()]
    assert got[0] == got[4] != got[1] and len(got[2]) == 3 and got[3] == []
    assert all(1 <= x <= 30 for x in got[0]) and 13 < np.mean(got[0]) < 17 and 3 < np.std(got[0]) < 7
    flat = df.limit(1).select(transcript.targets(F.col("k"), F.col("n"), uniform=True).alias("t")).first().t
    assert 1 <= min(flat) < 5 and 26 < max(flat) <= 30
    for bad in ({"least": 5, "most": 1}, {"mean": 500, "spread": 1}, {"spread": 0, "mean": 40}):
        with pytest.raises(ValueError):
            transcript.targets(F.col("k"), F.col("n"), **bad)


def test_chunks_with_a_target_for_each(spark):
    ss = [(i * 4_000, i * 4_000 + 4_000, str(i)) for i in range(9)]
    df = spark.createDataFrame([(ss, [4.0, 12.0, 8.0, 30.0]), ([], [])], f"s array<{transcript.SENTENCE}>, t array<double>")
    got = [[c.text for c in r.c] for r in df.select(transcript.chunks(F.col("s"), F.col("t")).alias("c")).collect()]
    assert got == [["0", "1 2 3", "4 5", "6 7 8"], []]


def test_drop_unmatched(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    same, other = {"language": "hu", "segments": [{"text": "a b"}]}, {"language": "ru", "segments": [{"text": "мама мыла"}]}
    put(root, {
        "x/a.txt": "A  b\n", "x/a.json": same, "x/a.mp3": "m", "x/b.txt": "папа купил\n", "x/b.json": other, "x/b.mp3": "m",
        "x/c.txt": "z", "x/c.json": same, "y/d.txt": "", "y/d.json": same, "y/d.mp3": "m",
    })
    done = pipelines.drop_unmatched(spark, str(root), str(out), most_edits=2)
    assert [(r.lang, r.lines, r.exact, r.normalized, r.unmatched_share, r.exact_share, r.normalized_share) for r in done["by_language"].collect()] == [("hu", 1, 0, 1, 50.0, None, 100.0), ("ru", 1, 0, 0, 50.0, None, 0.0)]
    assert done["totals"].first().lines == 2 and done["moves"].count() == 3
    assert sorted(p.name for p in out.rglob("*.*")) == ["b.json", "b.mp3", "b.txt"] and (root / "x" / "a.txt").exists() and (root / "x" / "c.txt").exists()


def test_move_noisy(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    put(root, {"x/loud.wav": tone(3), "x/loud.txt": "t", "x/loud.json": "{}", "x/calm.wav": tone(3, hz=200.0), "x/short.wav": tone(1), "x/bad.wav": b"no"})
    half = lambda x, rate: x * (0.5 if np.abs(np.fft.rfft(x)).argmax() > 250 * len(x) / rate else 1.0)
    rows = {Path(r.path).stem: r for r in pipelines.move_noisy(spark, str(root), str(out), half, length=2.0, report=str(tmp_path / "r")).collect()}
    assert set(rows) == {"loud", "calm", "bad"} and rows["bad"].error
    assert rows["loud"].speech_energy_ratio == pytest.approx(4.0) and rows["calm"].speech_energy_ratio == pytest.approx(1.0)
    assert sorted(p.name for p in out.rglob("*.*")) == ["loud.json", "loud.txt", "loud.wav"] and list((tmp_path / "r").glob("*.json"))


def test_randomized_copy_merge_and_publish(spark, tmp_path):
    root = tmp_path / "in"
    put(root, {"x/a.wav": tone(1), "x/a.txt": "Szia.", "x/b.wav": tone(1), "x/a.json": {"file": "a", "analysis": [{"label": "Speech", "score": 0.9}]}, "x/b.json": {"file": "b", "analysis": []}})
    rows = {Path(r.path).stem: r for r in pipelines.randomized_copy(spark, str(root), str(tmp_path / "copies")).collect()}
    assert rows["a"].warning is None and rows["b"].warning
    assert sorted(p.suffix for p in (tmp_path / "copies").iterdir()) == [".txt", ".wav", ".wav"]
    missing = pipelines.merge_json_txt(spark, str(root), str(tmp_path / "merged"))
    assert [Path(r.path).name for r in missing.collect()] == ["b.json"]
    merged = json.loads((tmp_path / "merged" / "x" / "a.json").read_text())
    assert merged["sentence"] == "Szia." and merged["analysis"] == [{"label": "Speech", "score": 0.9}]
    put(root, {"m.json": {"path": str(root / "x" / "a.wav"), "sentence": "s", "analysis": []}, "n.json": {"path": "/gone.wav", "sentence": "s", "analysis": []}})
    assert [Path(r.path).name for r in pipelines.publishable(spark, str(root), str(tmp_path / "set")).collect()] == ["a.wav"]


def test_spectra_and_noise_of_files(spark):
    rows = [("t", tone(2, hz=300.0)), ("low", tone(2, hz=50.0)), ("bad", b"x"), ("none", None), ("brief", tone(0.5))]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = {(r.path, r.label): r for r in signal.file_bands(df, "path", "content").collect()}
    assert got["t", "speech"].ratio > 0.99 and got["low", "low_hum"].ratio > 0.95 and got["bad", None].error and got["none", None].error
    assert got["t", "speech"].duration_sec == 2 and got["t", "speech"].sampling_rate == 8_000
    noise = {r.path: r for r in signal.file_noise(df, "path", "content").collect()}
    assert set(noise) == {"t", "low", "bad", "none"} and noise["t"].noise_db == pytest.approx(20 * np.log10(0.5 / 2**0.5), abs=1.5)
    x = np.random.default_rng(1).normal(size=5_000)
    frequency, energy = signal.stft_energy(x, 8_000)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(2048) / 2048)
    padded = np.pad(x, 1024)
    assert np.allclose(energy, sum(np.abs(np.fft.rfft(padded[k : k + 2048] * window)) ** 2 for k in range(0, len(padded) - 2047, 512)))
    assert signal.window_of(100, 30, "last") == (70, 100) and signal.window_of(20, 30, "last") == (0, 20) and signal.window_of(20, 30, "random", 0.5) is None
    part, rate, _ = signal.decoded(tone(2), 0.5, 1.0)
    assert len(part) == rate


def test_conversion_filters_what_the_lower_rate_cannot_hold():
    x = np.sin(np.arange(48_000) * 2 * np.pi * 20_000 / 48_000)[:, None]
    assert np.abs(signal.convert(x, 48_000, 24_000, 1)[200:-200]).max() < 0.05
    y = np.sin(np.arange(48_000) * 2 * np.pi * 440 / 48_000)[:, None]
    assert np.abs(signal.convert(y, 48_000, 24_000, 1)[200:-200]).max() == pytest.approx(1, abs=0.02)


def test_models_are_tried_again(spark):
    def flaky():
        import time

        count = {}

        def model(content):
            count[content] = count.get(content, 0) + 1
            if content == b"slow":
                time.sleep(5)
            if content == b"third" and count[content] < 3 or content == b"never":
                raise RuntimeError("no")
            return "{}"

        return model

    df = spark.createDataFrame([("a", b"ok"), ("b", b"third"), ("c", b"never"), ("d", b"slow"), ("e", None)], "k string, content binary")
    got = {r.k: (r.status, r.attempts) for r in models.apply_model(df, "k", "content", flaky, attempts=3, seconds=0.2).collect()}
    assert got == {"a": ("ok", 1), "b": ("ok", 3), "c": ("error", 3), "d": ("timeout", 3), "e": ("error", 0)}
    assert models.gpu_settings()["spark.task.resource.gpu.amount"] == "1" and models.supervision_settings()["spark.task.maxFailures"] == "4"


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from phonoloom import session

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isEmpty": lambda self: True})()})()})()

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": lambda self, *a: None})()

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


def test_random_names_differ(spark):
    from phonoloom.operators import curate

    df = spark.createDataFrame([(f"d/{random.random()}",) for _ in range(50)], "p string")
    assert df.select(curate.random_name(F.col("p"))).distinct().count() == 50


def test_spread_shuffles_only_few_splits(spark, tmp_path):
    from phonoloom import session

    df = spark.range(100_000).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("t"))
    df.repartition(8).write.parquet(str(tmp_path / "many"))
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    many, one = (spark.read.parquet(str(tmp_path / n)) for n in ("many", "one"))
    assert many.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert "Exchange" not in plan(session.spread(many)) and session.spread(many) is many
    assert one.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism and "Exchange" in plan(session.spread(one))
    assert session.spread(one).count() == 100_000


def test_stored_tables_are_released(spark):
    from phonoloom import session

    kept = session.stored(spark.range(3))
    where = Path(kept.inputFiles()[0].removeprefix("file:")).parent
    before, session._kept[:] = [k for k in session._kept if k[1] != str(where) and where.name not in k[1]], [k for k in session._kept if where.name in k[1]]
    assert where.exists()
    session.release()
    assert not where.exists()
    session._kept[:] = before
