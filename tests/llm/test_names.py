"""Columns with the names that operators use inside neither clash nor get lost."""

from __future__ import annotations

import pytest
from lotlens.llm import langid, lines, quality, toxicity
from pyspark.sql import functions as F

NAMES = ["label", "__gone", "__rid", "__lang", "__row", "row", "rid", "at", "gone", "found", "__id", "__text", "most", "total"]


@pytest.fixture(scope="module")
def named(odd):
    return odd.where("doc_id is not null").select("doc_id", "text", "lang", *[F.lit(f"own {n}").alias(n) for n in NAMES])


def kept(rows):
    return rows and all(r[n] == f"own {n}" for r in rows for n in NAMES)


@pytest.mark.parametrize("limit", [1 << 27, 0])
def test_line_dedup(named, limit):
    found = lines.dedup_lines(named, max_index_bytes=limit)
    assert found.columns == [*named.columns, "n_lines", "n_dropped"]
    assert kept(found.collect()) and found.count() == named.count()
    plain = {(r.doc_id, r.text) for r in lines.dedup_lines(named.select("doc_id", "text")).collect()}
    assert {(r.doc_id, r.text) for r in found.collect()} == plain


def test_languages(named):
    model = langid.learn(named)
    known, judged = langid.keep_known(named, model), langid.identify(named, model)
    assert known.columns == named.columns and kept(known.collect())
    assert judged.columns == [*named.columns, "lang_pred", "score"] and kept(judged.collect()) and judged.count() == named.count()


def test_classifiers(spark, named):
    labels = named.select("doc_id", F.pmod("doc_id", F.lit(2)).cast("int").alias("quality"), F.pmod("doc_id", F.lit(2)).cast("int").alias("toxic"))
    for module in (quality, toxicity):
        found = module.classify(named, module.learn(named, labels))
        assert kept(found.collect()) and found.count() == named.count()


def test_many_languages(spark, monkeypatch):
    """Of more values of the language column than are learned the commonest ones are."""
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    words = {"a": "eins zwei drei vier", "b": "one two three four", "c": "uno dos tres cuatro"}
    rows = [(k, f"{words[g]} {k % 5}", g) for k, g in enumerate(list("abc") * 20)] + [(1000 + k, "odd text here", f"x{k}") for k in range(40)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(model.languages) == ["a", "b", "c"]
