from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lotlens.llm import langid, quality, queries, spans, toxicity

SF = "/root/testdata/sf0.01"


def test_spans_agree_with_plain_python():
    texts = ["Ab, cd!! é-x", "", None, " two  words\n", "x" * 50]
    data, offsets = spans.buffers(pa.array(texts))
    start, end, first = spans.runs(data, offsets, spans.WORDS_AND_MARKS)
    got = [[bytes(data[a:b]).decode() for a, b in zip(start[first[i] : first[i + 1]], end[first[i] : first[i + 1]], strict=True)] for i in range(5)]
    assert got == [["Ab", ",", "cd", "!!", "é", "-", "x"], [], [], ["two", "words"], ["x" * 50]]
    same = pa.array(["word other", "some WORD", "a b word"])
    hashes = []
    for _, _, d, o in spans.slices(same, 10):
        s, e, _ = spans.runs(d, o, spans.WORDS)
        hashes.append({bytes(d[a:b]).lower(): int(h) for a, b, h in zip(s, e, spans.token_hashes(d, s, e), strict=True)})
    assert hashes[0][b"word"] == hashes[1][b"word"] == hashes[2][b"word"] != hashes[0][b"other"]


def test_language_id(spark):
    got = queries.op9_language_id(spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    held = got[got.held_out]
    assert len(held) > 200 and (held.lang_pred == docs.lang[held.index]).mean() > 0.98
    assert got.score.between(0, 1).all() and len(got) == len(docs)


def test_filter_corrects_false_positives():
    rng = np.random.default_rng(0)
    a, b = (np.unique(rng.integers(1, 2**32, 20_000)).astype(np.uint64) for _ in range(2))
    model = langid.LanguageFilter({"a": a, "b": b}, "a")
    masks = model.masks(np.concatenate([a, b]))[0]
    assert ((masks[: len(a)] & 1) == 1).all() and ((masks[len(a) :] & 2) == 2).all()  # no n-gram is missed
    other = model.masks(rng.integers(1, 2**32, 50_000).astype(np.uint64))[0]
    assert abs(float(np.mean(other & 1)) - model.false_rate[0]) < 0.01


def test_language_odd_rows(odd, none):
    model = langid.learn(odd)
    got = langid.identify(odd, model)
    assert got.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    by = {r["doc_id"]: r["lang_pred"] for r in got.collect()}
    assert [by[i] for i in (0, 1, 2, 3)] == ["und"] * 4 and by[14] == "en"  # letters, no known n-gram: the commonest
    assert langid.keep_known(odd, model).columns == odd.columns
    empty = langid.learn(none)
    assert langid.identify(none, empty).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"}


def test_quality_held_out(spark):
    got = queries.op10_quality(spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.95 and got.score.between(0, 1).all()


def test_toxicity_held_out(spark):
    got = queries.op2_toxicity(spark, "/root/testdata/sf0.1").toPandas().merge(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    hits = (held.predicted * held.toxic).sum()
    assert hits / held.predicted.sum() > 0.85 and hits / held.toxic.sum() > 0.8


def test_toxicity_gradients_match_differences():
    model = toxicity.ToxicityModel()
    model.know(np.arange(1, 1 << toxicity.BITS))
    for k in model.p:
        model.p[k] = model.p[k].astype(np.float64)
    rng = np.random.default_rng(2)
    ids = rng.integers(1, 1 << toxicity.BITS, (23, toxicity.PIECES)).astype(np.int32)
    first, y, w = np.array([0, 7, 7, 20, 23]), np.array([1.0, 0, 0, 1]), np.array([1.0, 2, 1, 1])

    def loss():
        z = model._pooled(ids, first) @ model.p["v"] + model.p["c"][0]
        return float((w * (np.logaddexp(0, z) - y * z)).sum() / w.sum())

    grads = model.gradients(ids, first, y, w)
    for name in ("v", "c", "F1", "F3", "b2"):
        at = tuple(0 for _ in model.p[name].shape)
        model.p[name][at] += 1e-5
        up = loss()
        model.p[name][at] -= 2e-5
        down = loss()
        model.p[name][at] += 1e-5
        assert abs((up - down) / 2e-5 - grads[name][1][at]) < 1e-4
    rows, g = grads["E"]
    model.p["E"][rows[0], 0] += 1e-5
    up = loss()
    model.p["E"][rows[0], 0] -= 2e-5
    down = loss()
    assert abs((up - down) / 2e-5 - g[0, 0]) < 1e-4


def test_thresholds_by_language():
    scores, y = np.array([0.9, 0.8, 0.2, 0.1] * 10), np.array([1, 1, 0, 0] * 10)
    got = toxicity.calibrated(scores, y, ["a"] * 40)
    assert got == {None: 0.5, "a": 0.5}
    assert set(toxicity.calibrated(scores, y, ["a", "b", "a", None] * 10)) == {None, "a", "b"}


def test_classifiers_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (5, 0, 1), (6, None, None), (None, 1, 1), (99, 1, 1), (13, 0, 1)], "doc_id long, quality int, toxic int")
    for module, label in ((quality, "quality"), (toxicity, "toxic")):
        model = module.learn(odd, labels, label)
        got = module.classify(odd, model)
        assert got.count() == odd.count() and got.where("score between 0 and 1").count() == odd.count()
        rows = got.collect()
        assert len({r["score"] for r in rows if r["doc_id"] in (10, 12)}) == 1
        assert len({r["score"] for r in rows if r["doc_id"] in (0, 1, 2)}) == 1
        assert module.classify(none, model).count() == 0
        blank = module.learn(none, labels, label)
        assert {r["score"] for r in module.classify(odd, blank).select(F.round("score", 3).alias("score")).collect()} == {0.5}


def test_rare_and_short_texts_keep_their_language(spark):
    """No text with a letter goes for being short, of rare words or of a language that a plain sample would miss."""
    rows = [(i, f"the house and the garden of number {i % 50} are here", "en") for i in range(3000)]
    rows += [(3000 + i, "дом и сад здесь", "ru") for i in range(3)] + [(4000, "A.", "en"), (4001, "De.", "de"), (4002, "Re.", "la"), (4003, "ξένος λόγος", None)]
    docs = spark.createDataFrame([*rows, (4004, "12 !!", "en"), (4005, "", "en"), (4006, None, "en")], "doc_id long, text string, lang string")
    model = langid.learn(docs, max_docs=300)
    assert sorted(r["doc_id"] for r in langid.keep_known(docs, model).collect()) == [i for i, _, _ in rows]
    got = {r["doc_id"]: r for r in langid.identify(docs.where("doc_id >= 3000"), model).collect()}
    assert {got[i]["lang_pred"] for i in (3000, 3001, 3002)} == {"ru"} and got[3000]["score"] > 0.5


def test_short_texts_have_an_ngram():
    data, offsets = np.frombuffer(b"A.De.longer", np.uint8), np.array([0, 2, 2, 5, 11])
    data, offsets = langid.padded(data, offsets)
    assert bytes(data) == b"A.  De. longer" and offsets.tolist() == [0, 4, 4, 8, 14]
    gram = langid.grams(data, offsets)
    assert gram[0] and gram[4] and not gram[1:4].any() and not gram[5:8].any()
