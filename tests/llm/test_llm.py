import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from phonoloom.llm import forms, langid, lookalike, mixing, pieces, repetition, sentences, subjects, tokens

CLEAN = [
    "There is a bright lamp between the door and each chair. The teacher praised the early letter over lunch. Welcome back to our long programme.",
    "The crew copied a voice. Nobody heard the street after dark. Please turn the volume down before the story begins.",
    "在这段录音里听得到没有人。大约有三个台灯。请把音量调低。",
]
MODEL = sentences.train(CLEAN)


def cut(text, cjk=False):
    words = list(text) if cjk else text.split()
    return [("" if cjk else " ").join(words[a : b + 1]) for a, b in sentences.segment(MODEL, words)]


def test_sentence_rules():
    assert cut("Dr. Holm praised the 2. lamp at 3.5 p.m. The crew copied it") == ["Dr. Holm praised the 2. lamp at 3.5 p.m.", "The crew copied it"]
    assert cut('The teacher said "Nobody heard the street!" and praised it. The crew copied a voice?') == ['The teacher said "Nobody heard the street!" and praised it.', "The crew copied a voice?"]
    assert cut("Nobody heard the street . The crew copied it") == ["Nobody heard the street .", "The crew copied it"]
    assert cut("Nobody heard the… street over lunch... The crew copied it") == ["Nobody heard the… street over lunch...", "The crew copied it"]
    assert cut("大约有4.5个台灯。请把音量调低", cjk=True) == ["大约有4.5个台灯。", "请把音量调低"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.", "", None, ".", '"', "x?​", "！", "Dr.", "“", "”", "…", "12.", "字"]), max_size=30))
def test_sentences_partition_the_row(words):
    got = sentences.segment(MODEL, words)
    assert [i for a, b in got for i in range(a, b + 1)] == list(range(len(words)))


def brute_segments(words):
    """The best segmentation by trying all of them."""
    import itertools

    cand = [c for c in sentences.scan(words)[0] if c[0] < len(words) - 1]
    best = None
    for some in itertools.product([False, True], repeat=len(cand)):
        ends = [c for c, s in zip(cand, some) if s]
        value = sentences.value_of(MODEL, words, ends)
        if best is None or value > best[0] + 1e-9:
            best = value, [c[0] for c in ends]
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", "b.", "Dr.", "The", "x?", '"', "p.m.", "12.", "cf.", "said…"]), min_size=1, max_size=14))
def test_segmentation_is_the_best_of_all(words):
    value, _ = brute_segments(words)
    ends = {b for _, b in sentences.segment(MODEL, words)[:-1]}
    cand = [c for c in sentences.scan(words)[0] if c[0] in ends]
    assert sentences.value_of(MODEL, words, cand) == pytest.approx(value)


def test_sentences_of_many_candidates():
    words = ["he"] + ["Dr."] * 400 + ["x", "left."] + ["The", "end."]
    assert sentences.segment(MODEL, words) == [(0, 402), (403, 404)]


def test_sentence_units(spark):
    df = spark.createDataFrame([(1, ["dark.", "Back"]), (1, ["dark.", "Back"]), (2, None), (3, []), (None, ["x"])], "id long, w array<string>")
    got = sentences.sentence_units(df, "id", F.col("w"), MODEL)
    assert sorted(map(tuple, got.collect())) == [(1, 0, 0), (1, 1, 1)]


def test_sentence_model_counts_every_row(spark):
    """Clean samples without a bound, and all rows: what only they show decides a doubtful mark."""
    texts = [(i, "The crew copied a voice.") for i in range(5_100)] + [(9_000, "Zolnar heard the street. Zolnar copied it.")]
    samples = spark.createDataFrame(texts, "sample_id long, text string").repartition(3)
    model = sentences.trained(samples)
    assert model.opens("zolnar", True) > 1 and model.of("zolnar") == (2, 0, 0, 0, 2)
    assert model.of("crew") == (0, 5_100, 0, 0, 5_100) and model.of("voice") == (0, 5_100, 0, 5_100, 0)
    local = sentences.train([t for _, t in texts])
    assert (model.hashes == local.hashes).all() and (model.counts == local.counts).all() and model.length == local.length
    words = "उसने सुना। फिर उसने देखा। फिर वह गया।".split()
    doubtful = "उसने वह घर देखा... फिर वह घर गया।".split()
    rows = [(i, words) for i in range(30)] + [(30, doubtful), (30, doubtful), (30, doubtful), (31, None), (None, doubtful)]
    rows = spark.createDataFrame(rows, "align_id long, words array<string>").repartition(4)
    learned = sentences.trained(samples, rows=rows)
    assert sentences.segment(model, doubtful) == [(0, 7)] and sentences.segment(learned, doubtful) == [(0, 3), (4, 7)]
    assert learned.of("फिर")[:2] == (60, 0) and learned.of("घर")[:2] == (0, 2)  # a row that comes in copies counts once
    assert sentences.trained(samples.limit(0), rows=rows.limit(0)).opens("crew", False) == 0.0


def test_sentence_queries_learn_from_their_rows(spark, tmp_path):
    from phonoloom.llm import queries

    words = "उसने सुना। फिर उसने देखा। फिर वह गया।".split()
    doubtful = "उसने वह घर देखा... फिर वह घर गया।".split()
    rows = [(i, [(w, float(k), k + 1.0) for k, w in enumerate(words)]) for i in range(30)] + [(30, [(w, 5.0 * k, 5.0 * k + 5) for k, w in enumerate(doubtful)])]
    spark.createDataFrame(rows, "align_id long, word_segments array<struct<word string, start double, end double>>").write.parquet(f"{tmp_path}/aligned_transcripts.parquet")
    for name in ("lang_samples", "subject_samples"):
        spark.createDataFrame([(1, "The crew copied a voice.")], "sample_id long, text string").write.parquet(f"{tmp_path}/{name}.parquet")
    assert {(r.first_word, r.last_word) for r in queries.p2_found(spark, str(tmp_path)).filter("align_id = 30").collect()} == {(0, 3), (4, 7)}
    # Eight words of five seconds: cut at the end that only the other rows show, the parts fit.
    assert [tuple(r) for r in queries.p3_found(spark, str(tmp_path)).collect()] == [(30, "natural")]
    cuts = queries.p3_pieces(spark, str(tmp_path)).orderBy("piece_no").select("first_word", "last_word", "repeated_words").collect()
    assert [tuple(r) for r in cuts] == [(0, 3, 0), (2, 7, 2)]


def line(*spans, after=()):
    return pieces.Timeline([s for s, _ in spans], [e for _, e in spans], [1 if i in after else 0 for i in range(len(spans))])


def test_cut_kind():
    assert pieces.pack(line((0, 100), (100, 30_001)))[1] == "forced"
    assert pieces.pack(line((0, 31_000), (31_000, 31_100), after={0}))[1] == "forced"
    assert pieces.pack(line((0, 20_000), (20_000, 40_000), after={0}))[1] == "natural"
    # A coarse separator is used before a fine one.
    x = line((0, 10_000), (10_000, 20_000), (20_000, 29_000), (29_000, 39_000), after={0, 1, 2})
    x.after[1] = pieces.PARAGRAPH
    assert pieces.split(x, 0, 3, pieces.SECTION, 30_000) == [(0, 1, pieces.PARAGRAPH), (2, 3, pieces.PARAGRAPH)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 90_000), st.integers(1, 12_000), st.booleans()), min_size=1, max_size=40), st.booleans())
def test_pieces_cover_and_fit(rows, ordered):
    spans = [(s, s + n) for s, n, _ in rows]
    spans = sorted(spans) if ordered else spans
    x = line(*spans, after={i for i, r in enumerate(rows) if r[2]})
    got, kind = pieces.pack(x, 30_000)
    runs, a = [], 0
    for i in range(len(rows)):
        if x.after[i] or i == len(rows) - 1:
            runs.append(x.reach(a, i))
            a = i + 1
    assert (kind == "forced") == (max(runs) > 30_000)
    fresh = [i for a, b, k in got for i in range(a + k, b + 1)]
    assert fresh == list(range(len(rows)))
    for n, (a, b, k) in enumerate(got):
        assert x.reach(a, b) <= 30_000
        assert k == 0 if n == 0 else k <= 2
        if n and k < 2 and got[n - 1][1] > got[n - 1][0]:
            assert x.reach(a - 1, a + k) > 30_000 or k == 1 or a == 0 or x.reach(a + k - 2, a + k) > 30_000


def test_slices():
    got = pieces.slices("abcdef", 0, 70_000, 30_000)
    assert "".join(t for t, _, _ in got) == "abcdef" and all(e - s <= 30_000 for _, s, e in got) and got[-1][2] == 70_000


def test_forms():
    assert forms.look("ｌо​оk аt") == "look at"
    assert forms.look("é") == forms.look("é") == "é" and forms.look("é") != forms.look("e")
    assert forms.look("m²") == "m²" and forms.look("Ab") != forms.look("ab")
    assert forms.plain("ДОМ") == forms.plain("дом")


def test_lookalikes(spark):
    rows = [(1, "héllo"), (2, "héllo"), (3, "hеllo"), (4, "hello"), (5, "Hello"), (6, None), (7, ""), (8, "​"), (8, "​"), (9, "hello")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, text string, value string")
    got = sorted(map(tuple, lookalike.same_look_pairs(df, "id", "text").collect()))
    assert got == [(1, 2), (3, 4), (3, 9), (7, 8)]
    canon = {r.id: r.canonical for r in lookalike.canonical_forms(df.select("id", "text"), "text").collect()}
    assert canon == {1: "héllo", 2: "héllo", 3: "hello", 4: "hello", 5: "Hello", 6: None, 7: "", 8: "", 9: "hello"}
    words = spark.createDataFrame([(1, ["„mіkrofon”,", "mikrofon", "Mіkrofon", None, "", "mikrofonok", "mikro­fon!"])], "id long, w array<string>")
    terms = spark.createDataFrame([("mikrofon",), (None,)], "term string")
    assert sorted(map(tuple, lookalike.term_lookalikes(words, "id", F.col("w"), terms, "term").collect())) == [(1, 0, "mikrofon"), (1, 6, "mikrofon")]


def test_equal_forms_share_their_bones(spark):
    """Over all code points: what the collation holds equal has one key, but for digits of different scripts and the stroke that
    lengthens Arabic words, which do not look the same; and every character has the key of its parts."""
    every = [chr(c) for c in (*range(1, 0xD800), *range(0xE000, 0x110000)) if unicodedata.category(chr(c)) != "Cn"]
    alone = [(c, c) for c in every if unicodedata.category(c) != "Nd" and c != "\u0640"]
    parts = [(f"{x}a", f"a{c}a") for c in every for x in (f"a{c}", "a" + unicodedata.normalize("NFD", c)) if unicodedata.normalize("NFD", c) != c]
    for rows, key in ((alone, F.collate(forms.looks_like(F.col("c")), lookalike.COLLATION)), (parts, F.col("of"))):
        made = spark.createDataFrame(rows, "c string, of string").select(key.alias("k"), lookalike.bones(forms.looks_like(F.col("c"))).alias("bones"), "c")
        bad = made.groupBy("k").agg(F.countDistinct("bones").alias("n"), F.min("c").alias("one"), F.max("c").alias("other")).filter("n > 1")
        assert [(r.one, r.other) for r in bad.limit(20).collect()] == []


def test_kelvin_and_other_characters_of_two_code_points(spark):
    words = spark.createDataFrame([(1, ["\u212aelvin", "Kelvin", "k\u0585rt", "\u2126hm", "Kel\u0301vin"])], "id long, w array<string>")
    terms = spark.createDataFrame([("Kelvin",), ("kort",), ("\u03a9hm",)], "term string")
    got = lookalike.term_lookalikes(words, "id", F.col("w"), terms, "term").collect()
    assert sorted(map(tuple, got)) == [(1, 0, "Kelvin"), (1, 2, "kort"), (1, 3, "\u03a9hm")]


def test_text_classes(spark):
    df = spark.createDataFrame([(1, "look"), (2, "l\u043eok"), (2, "l\u043eok"), (3, "look"), (4, "l\u200book"), (5, "other"), (6, None)], "id long, text string")
    assert sorted(map(tuple, lookalike.same_look_classes(df, "id", "text").collect())) == [(1, 1, 2), (2, 1, 3), (3, 1, 2), (4, 1, 3)]
    assert sorted(map(tuple, lookalike.same_look_pairs(df, "id", "text").collect())) == [(1, 2), (1, 4), (2, 3), (2, 4), (3, 4)]
    empty = df.filter("id < 0")
    assert lookalike.same_look_pairs(empty, "id", "text").collect() == lookalike.canonical_forms(empty, "text").collect() == []


def brute_share(words, run):
    grams = [tuple(words[i : i + run]) for i in range(len(words) - run + 1)]
    hit = {k for i, g in enumerate(grams) if g in grams[:i] for k in range(i, i + run)}
    return len(hit) / len(words) if words else 0.0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_share(words):
    assert repetition.repeated_share(words, 4) == pytest.approx(brute_share(words, 4))


def test_bands_lose_no_repetitive_item():
    import zstandard

    rng, press = random.Random(5), zstandard.ZstdCompressor(level=3)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(4000)]
    for n in (8, 12, 20, 40, 80, 200, 600, 2000):
        for _ in range(30):
            half = rng.choices(vocabulary, k=n)
            words, k = list(half), 0
            while len(words) < 2 * n + 2:
                k = rng.randrange(max(1, n - 4))
                words += half[k : k + rng.randint(4, 12)]
            if repetition.repeated_share(words, 4) >= 0.5:
                assert repetition.band(*repetition.ratios(words, 4, press)) == "repetitive"


def test_repetition_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "?!"), (4, "one two three four " * 5), (5, "a b c d e f g h")], "id long, text string")
    got = {r.item_id: (r.band, r.repeated_share) for r in repetition.repetition(df, "id", F.col("text")).collect()}
    assert got[1] == got[2] == got[3] == ("empty", 0.0) and got[4][1] == pytest.approx(0.8) and got[5][1] == 0
    assert [r.item_id for r in repetition.repetition(df, "id", F.col("text"), True).collect()] == [4]


def test_languages(spark):
    text = {"en": "the crew heard the voice of the teacher and this was the story", "de": "das war nicht der Lehrer und die Stimme hörte jeder noch", "ru": "это был голос и никто не заметил наш вечер сегодня"}
    model = langid.fit(list(text.values()) * 2, list(text) * 2)
    assert [model.languages[i] for i in model.scores([langid.normal(t) for t in ("THE TEACHER HEARD THE STORY", "die Stimme war nicht das", "никто не заметил голос")]).argmax(1)] == ["en", "de", "ru"]
    rows = [(1, "deu", [text["de"], "", text["de"], text["en"]]), (2, None, [text["en"]]), (3, "xx", ["♪ 12:30", None]), (4, "EN-gb", [text["en"]]), (5, "en", None)]
    df = spark.createDataFrame(rows, "id long, lang string, parts array<string>")
    got = {(r.item_id, r.seg_no): (r.lang, r.label_lang) for r in langid.languages(df, "id", "lang", F.col("parts"), model).collect()}
    assert got == {(1, -1): ("de", "de"), (1, 3): ("en", "de"), (2, -1): ("en", None), (4, -1): ("en", "en")}
    assert langid.label_language("hu_HU") == "hu" and langid.label_language("jpn") == "ja" and langid.label_language(" und ") is None


def test_encoding_equals_the_library(spark):
    from tokenizers import Tokenizer

    ref = Tokenizer.from_file(tokens.default_path())
    ref.encode_special_tokens = True
    texts = ["Hello world, it's 3.5!", "", None, "<|endoftext|> x", "字" * 300, "aaaaaaaaaaaaaaab" * 40, "  \n\t é é 🎙️ नमस्ते", "\x00​"]
    want = [ref.encode(t, add_special_tokens=False).ids if t else [] for t in texts]
    assert tokens.Encoder(*tokens.load(), steps=3, size=200).encode(texts) == want
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [list(r.ids) for r in tokens.encoded(df, "doc_id", "text").orderBy("doc_id").collect()] == want


def test_mixing(spark):
    rng = random.Random(1)
    sizes = [(i, s, rng.randint(1, 50)) for i in range(2000) for s in [rng.choice(["a", "a", "a", "b", "tiny"] if i % 20 else ["tiny"])]]
    df = spark.createDataFrame(sizes + [(9000, "a", 0)], "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.5, 2), ("B ", 0.3, 3), ("tiny", 0.1, 4), ("gone", 0.1, 9), ("zero", 0.0, 1)], "source string, target_share double, max_repeats int")
    p = mixing.plan(df, targets)
    mix = mixing.mixed(df, p).collect()
    assert [r.position for r in mix] == sorted(r.position for r in mix) and all(0 <= r.position <= 1 for r in mix)
    got = {r.source: r for r in mixing.shares(mixing.mixed(df, p), p).collect()}
    for s, share in (("a", 0.5), ("b", 0.3), ("tiny", 0.1)):
        assert got[s].actual_share == pytest.approx(share / 0.9, abs=0.01) and got[s].most_uses <= got[s].max_repeats
    assert got["gone"].actual_share == got["zero"].actual_share == 0 and 9000 not in {r.doc_id for r in mix}
    assert len({(r.doc_id, r.use_no) for r in mix}) == len(mix)
    empty = df.limit(0)
    assert mixing.mixed(empty, mixing.plan(empty, targets)).count() == 0


def test_position_inverts_the_schedule():
    for tilt in (-0.5, -0.1, 0.0, 0.3):
        for t in (0.0, 0.2, 0.9, 1.0):
            done = t + tilt * (t * t - t)
            rest = 1 - tilt
            assert (done if abs(tilt) < 1e-9 else 2 * done / (rest + np.sqrt(rest * rest + 4 * tilt * done))) == pytest.approx(t)


def test_text_in_brackets_is_speech_unless_it_is_short():
    assert langid.normal("(laughter) [00:01] <i>Hello</i>") == "hello"
    assert langid.normal("(Nobody heard the street after dark, and the crew copied a voice.)").startswith("nobody heard the street")
    assert langid.label_language("pt-BR") == "pt" and langid.label_language("hun") == "hu" and langid.label_language("und") is None and langid.label_language("unknown") is None


def test_summed_gradients_are_those_of_all_rows():
    rng = np.random.default_rng(3)
    known = np.arange(0, 400, 2, dtype=np.int32)
    model = subjects.Embedded.fresh(["law", "sport"], known, np.linspace(0.1, 1, 200).astype(np.float32))
    lengths = rng.integers(0, 6, 50)
    slots, target = rng.integers(0, 400, lengths.sum()).astype(np.int32), (rng.random((50, 2)) < 0.3).astype(np.float32)

    def loss(m):
        rows = subjects.Rows(slots, lengths, known, m.weight)
        p = subjects.sigmoid(rows.average(m.table) @ m.out + m.bias)
        return -(target * np.log(p) + (1 - target) * np.log(1 - p)).sum()

    whole = np.zeros_like(model.table)
    used, (first, out, bias) = subjects.gradient(model, subjects.Rows(slots, lengths, known, model.weight), target)
    whole[used] = first
    halves = [np.zeros_like(model.table), np.zeros_like(model.out), np.zeros_like(model.bias)]
    for a, b in ((0, 20), (20, 50)):
        x, y = lengths[:a].sum(), lengths[:b].sum()
        u, g = subjects.gradient(model, subjects.Rows(slots[x:y], lengths[a:b], known, model.weight), target[a:b])
        halves[0][u] += g[0]
        halves[1] += g[1]
        halves[2] += g[2]
    for mine, theirs in zip((whole, out, bias), halves):
        assert np.allclose(mine, theirs, atol=1e-5)
    model.table, model.out, model.bias = (x.astype(np.float64) for x in model.parameters)
    for values, g in ((model.table, whole), (model.out, out), (model.bias, bias)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before = values[at]
        values[at] = before + 1e-3
        up = loss(model)
        values[at] = before - 1e-3
        assert (up - loss(model)) / 2e-3 == pytest.approx(g[at], rel=0.05)
        values[at] = before


def test_subject_sentences():
    assert subjects.document_sentences("The crew copied a voice. The crew copied a voice! Nobody heard.\n\n", MODEL) == ["the crew copied a voice", "nobody heard"]
    assert unicodedata.normalize("NFC", "é") == "é"


def _subject_tables(spark, n=3_000):
    rng = random.Random(4)
    rest = "the lamp was early and nobody heard story of his crew".split()
    seen = {"law": "judge court lawyer notary statute clause".split(), "sport": "goal league medal racket relay sprint".split()}
    rare = {"law": "verdict", "sport": "coach"}
    samples = [(i, s, "en", " ".join(rng.sample(rest, 5) + rng.sample(seen.get(s, rest), 1))) for i, s in enumerate(["law", "sport", "none"] * 20)]
    documents = []
    for i in range(n):
        s = [None, "law", "sport", None][i % 4]
        lines = [" ".join(rng.sample(rest, 6) + ([rng.choice(seen[s])] if s else [])) for _ in range(3)]
        # Words that no sample has.
        lines += [f"{lines[0]} {rare[s]}"] if s and i % 11 == 0 else []
        documents.append((i, "en", "\n".join(lines)))
    extra = [(n, "en", None), (n + 1, None, ""), (n + 2, "xx", " \n...\n"), (None, "en", "the judge")]
    return spark.createDataFrame(documents + extra, "doc_id long, lang string, text string"), spark.createDataFrame(samples, "sample_id long, subject string, lang string, text string")


def test_subject_training_reads_every_document(spark, monkeypatch):
    documents, samples = _subject_tables(spark)
    rows = subjects.split(documents, "doc_id", "lang", "text", MODEL)
    found = {}
    # Gradients added on the driver, and by ranges of features on workers.
    for most in (subjects.DRIVER_BYTES, 0):
        monkeypatch.setattr(subjects, "DRIVER_BYTES", most)
        monkeypatch.setattr(subjects, "STAGES", 2)
        model = subjects.train(rows, samples, MODEL)
        got = model.logits(["verdict", "coach", "lamp was early", ""])
        law, sport = model.subjects.index("law"), model.subjects.index("sport")
        assert got[0, law] > 0 > got[0, sport] and got[1, sport] > 0 > got[1, law] and got[2:].max() < 0
        found[most] = {(r.doc_id, r.subject) for r in subjects.subject_shares(rows, model).filter("share >= 0.25").collect()}
        assert found[most] == {(i, "law" if i % 4 == 1 else "sport") for i in range(3_000) if i % 4 in (1, 2)}
    assert len(set(map(frozenset, found.values()))) == 1


def test_subjects_of_an_empty_table(spark, monkeypatch):
    monkeypatch.setattr(subjects, "STAGES", 1)
    documents, samples = _subject_tables(spark, 0)
    rows = subjects.split(documents.filter("doc_id < 0"), "doc_id", "lang", "text", MODEL)
    assert subjects.subject_shares(rows, subjects.train(rows, samples, MODEL)).collect() == []
    empty = spark.createDataFrame([], samples.schema)
    rows = subjects.split(documents, "doc_id", "lang", "text", MODEL)
    assert subjects.subject_shares(rows, subjects.train(rows, empty, MODEL)).collect() == []


def test_subject_features_of_scripts_without_spaces():
    assert subjects.tokens(subjects.letters("コートの審判が 実験")) == ["コート", "の", "審判", "が", "実験"]
    assert subjects.features("courts") == ["courts", "<court"] and subjects.features("court") == ["court"]


def test_repetition_does_not_depend_on_the_band(spark):
    import zstandard

    rng, press, lost = random.Random(9), zstandard.ZstdCompressor(level=3), []
    for i in range(4_000):
        characters = [chr(c) for c in rng.sample(range(0x4E00, 0x9FA0), 64)]
        n = rng.randint(3, 5)
        runs = ["".join(characters[8 * k : 8 * k + 8]) for k in range(n)]
        text = "".join(runs) + "".join(rng.sample(runs, n))
        words, run = repetition.units(text)
        if repetition.repeated_share(words, run) >= 0.5 and repetition.band(*repetition.ratios(words, run, press)) != "repetitive":
            lost.append((i, text))
    # Copies beyond the window of the compressor.
    far = "".join(chr(c) for c in np.random.default_rng(1).integers(0x4E00, 0x9FA0, 800_000))
    lost.append((9_999, far + far))
    df = spark.createDataFrame(lost, "id long, text string")
    assert {r.item_id for r in repetition.repetition(df, "id", F.col("text"), True).collect()} == {i for i, _ in lost}


def test_invisible_characters_at_the_edge_of_a_word_count(spark):
    edges = [chr(c) for c in forms.INVISIBLE]
    words = spark.createDataFrame([(1, [f"({c}mikrofon)" for c in edges] + [f"mikrofon{c}." for c in edges] + ["(mikrofon)."])], "id long, w array<string>")
    terms = spark.createDataFrame([("mikrofon",)], "term string")
    assert sorted(map(tuple, lookalike.term_lookalikes(words, "id", F.col("w"), terms, "term").collect())) == [(1, i, "mikrofon") for i in range(2 * len(edges))]
