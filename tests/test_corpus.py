import wave
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from phonoloom.functions import numbers, paths, text
from phonoloom.operators import agreement, curate, models, profile, signal, transcript
from phonoloom.sinks import writers
from phonoloom.session import stored
from phonoloom.sources import catalog

WORDS = "id int, w array<struct<word:string,start:double,end:double>>"


def one(spark, shape, *values):
    return spark.createDataFrame([values], shape)


def sentences(spark, words):
    df = transcript.with_sentences(one(spark, WORDS, 1, words), "w")
    return [tuple(s) for s in df.first().sentences]


def test_sentences(spark):
    assert sentences(spark, [("Hello", 0.0, 0.5), ("world", 0.5, 1.0)]) == [(0, 1000, "Hello world")]
    assert len(sentences(spark, [("a.", 0.0, 1.0), ("b", 1.0, 2.0)])) == 2
    assert sentences(spark, [("a.", 0.0, 1.0), ("b", 1.0, 2.0), ("c", None, None)]) == [(0, 1000, "a.")]
    assert sentences(spark, [("a", 0.0, 1.0), (" ,", 1.0, 1.5), (None, 1.5, 1.6), ("b!", 1.0015, 2.0)]) == [(0, 2000, "a,  b!")]
    assert sentences(spark, []) == [] and sentences(spark, [("x", float("nan"), 1.0)]) == []


def chunked(spark, ss, **kw):
    df = one(spark, f"s array<{transcript.SENTENCE}>", [(a, b, str(i)) for i, (a, b) in enumerate(ss)])
    return [r.text for r in df.select(F.inline(transcript.chunks(F.col("s"), **kw))).collect()]


def test_chunks(spark):
    assert chunked(spark, [(0, 40_000)]) == ["0"]
    assert chunked(spark, [(0, 0), (0, 40_000)]) == ["0 1"]
    assert chunked(spark, [(0, 16_000), (16_000, 20_000)]) == ["0", "1"]
    assert chunked(spark, [(0, 10_000), (10_000, 31_000)]) == ["0", "1"]
    assert chunked(spark, [(0, 5_000), (5_000, 9_000), (9_000, 16_000), (16_000, 17_000)]) == ["0 1 2", "3"]
    with pytest.raises(ValueError):
        transcript.chunks(F.col("s"), least=5, most=1)


def test_legacy_sentences(spark):
    words = [("x", 0.0, 1.0), ("Ab", 1.0, 2.0), ("c.", 2.0, 3.0), ("d.", 3.0, 4.0), ("E", None, 5.0), ("f.", 5.0, 6.0), ("G.", 6.0, 6.1), ("H", 7.0, None)]
    df = transcript.with_legacy_sentences(one(spark, WORDS, 1, words), "w")
    assert [(s.text, s.status) for s in df.first().sentences] == [("Ab c. d.", "kept"), ("E f.", "start_missing"), ("G.", "short"), ("H", "end_missing")]


def test_match_cascade(spark):
    pairs = spark.createDataFrame([(1, "A  b\r\nárvíz\nx", [("a b",), ("arviz",)], None), (2, "", [], "hu"), (3, None, [("a",)], "hu")], "id int, text string, segments array<struct<text:string>>, language string")
    rows = agreement.line_pairs(pairs, ["id"], "text", "segments", "language")
    got = [(r.lang, r.is_exact, r.is_norm) for r in agreement.matches(rows, 2).orderBy("line_no").collect()]
    assert got == [("UNKNOWN", False, True), ("UNKNOWN", False, True)]
    assert [r.is_norm for r in agreement.matches(rows, 1).orderBy("line_no").collect()] == [True, False]
    assert agreement.totals(agreement.matches(rows, 0), ["id"]).first().lines == 2


def test_language_moves(spark):
    f = spark.createDataFrame([("d", "x", "json"), ("d", "x", "txt"), ("d", "y", "json"), ("d", "y", "mp3"), ("d", "z", "mp3")], "dir string, base string, ext string")
    v = spark.createDataFrame([("d", "x", False, None), ("d", "y", True, True)], "dir string, base string, valid boolean, bad boolean")
    got = {(r.base, r.ext) for r in curate.language_moves(f, v).filter("moves").collect()}
    assert got == {("x", "txt"), ("y", "json"), ("y", "mp3"), ("z", "mp3")}


def test_text_functions(spark):
    q = lambda c, v: one(spark, "t string", v).select(c(F.col("t"))).first()[0]
    assert q(text.normal, "  A\t\nb ") == "a b"
    assert q(text.has_digit, "a٣b") and not q(text.has_digit, None)
    assert q(text.rule_violations, "") == ["empty"] and q(text.rule_violations, "a") == ["not_upper", "no_end"]
    assert q(text.lines, "a\r\nb\rc\n") == ["a", "b", "c"]
    assert q(text.bare, "It's, OK!") == "its ok"
    assert q(numbers.int_list, "0, 1,x") == [0, 1, None]
    letters = profile.letter_frequency(one(spark, "t string", "dzsdz"), "t").filter("n > 0").collect()
    assert {(r.letter, r.n) for r in letters} == {("dzs", 1), ("dz", 1)}
    assert len(text.HUNGARIAN) == 44


def test_paths(spark):
    got = one(spark, "p string", "/a\\b/.x.tar.WAV").select(*paths.parts(F.col("p"))).first()
    assert tuple(got) == ("/a/b", ".x.tar", "wav")
    assert one(spark, "p string", "/a/.hidden").select(*paths.parts(F.col("p"))).first().ext == ""


def test_speech_gate_and_dedup(spark):
    scores = "s array<struct<label:string,score:double>>"
    assert one(spark, scores, [("Music", 0.9)]).select(curate.low_score(F.col("s"))).first()[0]
    assert not one(spark, scores, [("Speech", 0.95)]).select(curate.low_score(F.col("s"))).first()[0]
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "id int, t string")
    assert {(r.id, r.is_first) for r in curate.keep_first(rows, "t", "id").collect()} == {(1, True), (2, False), (3, True), (4, True)}


def test_durations(spark):
    df = spark.createDataFrame([(30.0,), (None,), (10.0,)], "x double")
    assert profile.duration_totals(df, "x").first().long_items == 0
    h = profile.histogram(df, "x").collect()
    assert sum(r.n for r in h) == 2 and len(h) == 30 and max(r.bin for r in h if r.n) == 29
    assert sum(r.n for r in profile.histogram(df.filter("x = 10"), "x").collect()) == 1


def test_wav_and_files(spark, tmp_path):
    tone = np.sin(np.arange(16_000) / 20)[:, None] * 0.5
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.WAV").write_bytes(signal.write_wav(np.repeat(tone, 2, 1), 16_000))
    (tmp_path / "d" / "b.wav").write_bytes(b"broken")
    (tmp_path / "d" / "a.json").write_text('{"language": "hu", "segments": [{"text": "x"}]}')
    (tmp_path / "d" / "c.json").write_text("{bad")
    (tmp_path / "d" / "a.txt").write_text("x\n")
    files = catalog.files(spark, str(tmp_path))
    assert {(r.dir, r.base, r.ext) for r in files.collect()} == {("d", "a", "wav"), ("d", "b", "wav"), ("d", "a", "json"), ("d", "c", "json"), ("d", "a", "txt")}
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).filter("lower(path) like '%.wav'")
    done = {Path(r.path).name: r for r in signal.convert_files(content, "path", "content").collect()}
    assert done["b.wav"].status == "error" and done["a.WAV"].status == "converted"
    x, rate, width = signal.read_wav(bytes(done["a.WAV"].content))
    assert (rate, width, x.shape) == (24_000, 2, (24_000, 1))
    assert sorted(r.s or 0 for r in content.select(signal.wav_seconds(F.col("content")).alias("s")).collect()) == [0, 1.0]
    assert signal.slice_wav(bytes(done["a.WAV"].content), 500, 400) is None
    js = {Path(r.path).name: (r.valid, r.language) for r in catalog.json_files(spark, str(tmp_path), catalog.TRANSCRIPT).collect()}
    assert js == {"a.json": (True, "hu"), "c.json": (False, None)}
    out = models.apply_model(content, "path", "content", models.Stub)
    assert {r.status for r in out.collect()} == {"ok"}
    m = stored(curate.manifest(files.filter("ext = 'txt'"), "path", F.lit(True), str(tmp_path / "out")))
    assert writers.apply_manifest(m)["moved"] == 1 and writers.apply_manifest(m)["skipped"] == 1
    assert isinstance(wave.open(str(tmp_path / "d" / "a.WAV")), wave.Wave_read)


def test_metadata_csv(spark, tmp_path):
    writers.metadata_csv(spark.createDataFrame([("/a.wav", 'x "y"|z'), ("/b.wav", "")], "audio_path string, text string"), str(tmp_path / "m"), single=True)
    data = next((tmp_path / "m").glob("*.csv")).read_bytes().decode()
    assert sorted(data.splitlines()) == ['/a.wav|"x ""y""|z"', "/b.wav|"] and "\r\n" in data
