"""Language and quality models: gradients, held-out accuracy, defined cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import ROWS, frame
from leadlink.llm import language_id, quality


def slope(loss, value, place, e=1e-6):
    old = value[place]
    value[place] = old + e
    up = loss()
    value[place] = old - e
    down = loss()
    value[place] = old
    return (up - down) / (2 * e)


def test_language_gradients():
    rng = np.random.default_rng(0)
    m = {k: v.astype(np.float64) for k, v in language_id.new_model(3, 4).items()}
    x, label = rng.integers(97, 103, (7, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    _, g = language_id.gradients(m, x, label)
    for k, v in m.items():
        for _ in range(4):
            place = (int(rng.integers(v.shape[0])), int(rng.integers(v.shape[1])) if not k.endswith("in") else int(rng.integers(97, 103)))
            assert g[k][place] == pytest.approx(slope(lambda: language_id.gradients(m, x, label)[0], v, place, 1e-5), abs=1e-7)


def test_every_byte_is_read_once_whatever_the_block():
    m = language_id.new_model(3, 4)
    texts = [bytes(np.random.default_rng(k).integers(32, 250, n).tolist()) for k, n in enumerate((1, 5, 96, 97, 1000))]
    want = language_id.pooled(m, texts, 96)
    assert np.allclose(language_id.pooled(m, texts, 96, block=3), want, atol=1e-5)
    assert np.allclose(want.sum(axis=1), 1, atol=1e-4)
    alone = np.concatenate([language_id.pooled(m, [t], 96) for t in texts])
    assert np.allclose(alone, want, atol=1e-5)


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = language_id.predict(docs).collect()
    assert len(got) == len(lang) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.97


def test_language_defined_cases(spark):
    got = language_id.predict(frame(spark)).collect()
    said = {(r.doc_id, r.lang_pred) for r in got}
    assert len(got) == len(ROWS) and {i for i, w in said if w == "und"} == {4, 5, 6, 7, None}
    assert {w for _, w in said} <= {"und", "en", "de"}  # de from row 9 alone: row 7 has no letter
    none = language_id.predict(frame(spark, [(1, "text", None)])).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert language_id.predict(frame(spark, [])).collect() == []
    kept = language_id.accepted(frame(spark))
    assert kept.columns == frame(spark).columns and sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 2, 2, 3, 8, 9, 10, 11, 12, 13]


def test_quality_gradients():
    rng = np.random.default_rng(0)
    m = quality.new_model(6, 4, 3, 1)
    x, owner, label = rng.normal(size=(9, 6)), np.array([0, 0, 1, 1, 1, 2, 3, 3, 3]), np.array([0, 1, 1, 0.0])
    _, g = quality.gradients(m, x, owner, label)
    for k, v in m.items():
        for _ in range(4):
            place = tuple(int(rng.integers(s)) for s in v.shape)
            assert g[k][place] == pytest.approx(slope(lambda: quality.gradients(m, x, owner, label)[0], v, place), abs=1e-7)


def test_quality_learns_which_passage_matters():
    """One bad passage makes a bag bad; attention must find it."""
    rng = np.random.default_rng(1)
    bags, label = [], []
    for _ in range(600):
        x, bad = rng.normal(size=(int(rng.integers(1, 9)), 5)), bool(rng.integers(2))
        x[:, 0] = -1
        if bad:
            x[rng.integers(len(x)), 0] = 3
        bags.append(x)
        label.append(1.0 - bad)
    m = quality.train(bags, np.array(label), hidden=8, attention=8, epochs=40)
    p, (_, _, _, a, _) = quality.forward(m, np.concatenate(bags), np.repeat(np.arange(600), [len(b) for b in bags]), 600)
    assert ((p > 0.5) == np.array(label)).mean() > 0.97
    marked = np.concatenate(bags)[:, 0] == 3
    assert a[marked].mean() > 0.6


def test_quality_on_held_out_documents(spark):
    root = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{root}/labels.parquet")
    docs = spark.read.parquet(f"{root}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.score(docs, labels).collect()
    assert len(got) == len(truth) and all(r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.7) for r in got)
    out = [(truth[r.doc_id], r.predicted) for r in got if r.held_out]
    assert np.mean([a == b for a, b in out]) > 0.97
    assert np.mean([b for a, b in out if a == 1]) > 0.98 and np.mean([b for a, b in out if a == 0]) < 0.1


def test_quality_defined_cases(spark):
    labels = spark.createDataFrame([(1, 1, "x"), (2, 0, "x"), (3, None, "x"), (8, 0, "x"), (10, 1, "x"), (None, 1, "x"), (999, 0, "x")], "doc_id long, quality int, label string")
    got = quality.score(frame(spark), labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    texts = {i: t or "" for i, t, _ in ROWS if i is not None}
    by = {}
    for r in got:
        if r.doc_id is not None:
            by.setdefault(texts[r.doc_id], set()).add(round(r.score, 6))
    assert all(len(s) == 1 for s in by.values())
    assert quality.score(frame(spark, []), labels).collect() == []
    one = quality.score(frame(spark), labels.where("quality = 1")).collect()
    assert {r.score for r in one} == {1.0} and {r.predicted for r in one} == {1}
    assert {r.score for r in quality.score(frame(spark), labels.where("false")).collect()} == {0.5}


def hot(n):
    """Labelled rows, a third of them under one learnable id, a third without an id."""
    one = next(k for k in range(10) if not held(k))
    return [((one, None, 1000 + k)[k % 3], f"text number {k} about things", "en") for k in range(n)]


def test_bounds_of_the_training_samples_hold_under_repeated_ids(spark, monkeypatch):
    docs = frame(spark, hot(900) * 2)
    rows = docs.selectExpr("doc_id AS id", "text", "lang")
    assert len(language_id.sample(rows, rows["lang"], 50)) == 50  # each text is one snippet
    seen = []
    monkeypatch.setattr(quality, "train", lambda bags, label: seen.append(len(bags)))
    ids = sorted({i for i, _, _ in hot(900) if i is not None})
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)] * 2, "id long, label int")
    quality.fit(rows, labels, 512, 40, 4)
    assert seen == [40]


def test_signs_are_no_letters(spark):
    rows = [(1, "a plain text", "en"), (2, "½ ² ①", "en"), (3, "another plain text", "en"), (4, "12 ½ x", "en")]
    assert {r.doc_id for r in language_id.predict(frame(spark, rows)).collect() if r.lang_pred == "und"} == {2}


def test_the_filter_rejects_letters_never_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    foreign = ["Καλημέρα κόσμε, πώς είσαι σήμερα φίλε μου;", "中文文本在这里我们看到很多汉字", "привет, как дела сегодня", "½ ²"]
    extra = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(foreign)], "doc_id long, text string")
    got = language_id.accepted(docs.unionByName(extra, allowMissingColumns=True))
    want = {r.doc_id for r in docs.collect() if r.text and language_id.LETTER.search(r.text)}
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == want


def test_the_filter_keeps_texts_where_nothing_was_learned(spark):
    got = language_id.accepted(frame(spark, [(1, "text", None), (2, "...", None), (None, "more", None), (3, None, None)]))
    assert sorted(r.text for r in got.collect()) == ["more", "text"]


def test_the_filter_learns_from_all_rows(spark):
    """More documents than the training starts from, each in letters of its own."""
    texts = ["plain words here", "просто слова здесь", "απλές λέξεις εδώ", "մի քանի բառ այստեղ", "რამდენიმე სიტყვა აქ", "כמה מילים כאן"]
    ids = [k for k in range(100) if not held(k)]
    rows = [(i, t, "xx") for i, t in zip(ids, texts, strict=False)] + [(1000, "λέξεις", None), (1001, "中文文本", None)]
    got = language_id.accepted(frame(spark, rows), per_language=1)
    assert sorted(r.doc_id for r in got.collect()) == [*ids[: len(texts)], 1000]


def test_the_filter_writes_scores_without_texts(spark, monkeypatch):
    written, stored = [], language_id.stored
    monkeypatch.setattr(language_id, "stored", lambda df, label: written.append(df.dtypes) or stored(df, label))
    rows = [(1, "plain words here", "en"), (3, "more of the plain words", "en"), (1, "中文文本", None), (None, "中文文本", "en"), (None, "words", "en"), (1, None, "en")]
    for few in (200_000, 0):
        got = language_id.accepted(frame(spark, rows), few=few)
        assert got.columns == frame(spark).columns
        assert sorted(r.text for r in got.collect()) == ["more of the plain words", "plain words here", "words"]
    assert len(written) == 4 and all(kind in ("binary", "boolean", "double") for columns in written for _, kind in columns)


def test_every_window_of_every_row_counts_in_the_gradient():
    m = language_id.new_model(2, 4)
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdé "), n)) or "a" for n in (1, 7, 8, 9, 500, 64)]
    lang, each = ["en", "de", "en", "de", "de", "en"], {"en": 0.01, "de": 0.003}
    data, start, owner = language_id.windows([t.encode() for t in texts], 8)
    joined = b"".join(t.encode().ljust(8) for t in texts)
    assert data.tobytes() == joined and set((start[:, None] + np.arange(8)).ravel()) == set(range(len(joined)))
    of = np.array([["de", "en"].index(w) for w in lang])[owner]
    want = language_id.gradients(m, data[start + np.arange(8)[:, None]], of, np.array([0.003, 0.01], np.float32)[of])[1]
    for cuts in ([6], [1, 5], [2, 1, 3]):
        g, letters, at = {k: np.zeros(v.shape) for k, v in m.items()}, set(), 0
        for n in cuts:
            batch = pa.RecordBatch.from_pydict({"lang": lang[at : at + n], "text": texts[at : at + n]})
            at += n
            for out in language_id._slopes(m, ["de", "en"], each, 8)(iter([batch])):
                for part, k, v in zip(*(c.to_pylist() for c in out.columns), strict=True):
                    if part == "letter":
                        letters.add(chr(k))
                    else:
                        g[part].flat[k] += v
        assert letters == {c for t in texts for c in t if c.isalpha()}
        assert all(np.allclose(g[k], want[k], atol=1e-6) for k in want)
