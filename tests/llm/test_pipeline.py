"""run() against the same five steps in plain Python on the smallest tables."""

from __future__ import annotations

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from lotlens.llm import langid, simhash
from test_lines import brute as plain_lines

SF = "/root/testdata/sf0.001"


def tokens(t):
    return f" {' '.join(w.lower() for w in re.findall(r'[A-Za-z0-9\x80-\U0010ffff]+', t))} "


def near_groups(rows):
    wide = {i: simhash.word_prints(t) for i, t in rows}
    sets = {i: set(simhash.shingle_set(t, 5).tolist()) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(root)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            one, two = sorted((wide[i][k] ^ wide[j][k]).bit_count() for k in (0, 1))
            if one <= 7 and two <= 16 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_pipeline_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if langid.has_letter(t)]
    seen = {r["doc_id"] for r in langid.keep_known(docs, langid.learn(docs)).collect()}
    assert {i for i, _ in rows} <= seen  # documents with text in some language stay
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in seen]
    rows = [(i, t) for i, t, _, _ in plain_lines(rows)]
    groups = near_groups(rows)
    rows = [(i, t) for i, t in rows if groups[i] == i]
    items = [tokens(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = dict((i, t) for i, t in rows if not any(x in tokens(t) for x in items))
    got = corpus_pipeline.run(spark, SF).collect()
    joined: dict[int, str] = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["piece"])):
        joined[r["doc_id"]] = joined.get(r["doc_id"], "") + r["text"]
    assert joined == rows
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in got}) == len(got)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(spark, odd, none, name, stage):
    for docs in (odd, none):
        got = stage(spark, docs, SF)
        if name != "packing":
            assert got.columns == docs.columns
        assert got.count() <= 2 * docs.count() + 50
    assert stage(spark, none, SF).count() == 0


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = docs.dropDuplicates(["text"]).where(F.length("text") > 400)
    assert corpus_pipeline.known_language(spark, clean, SF).count() == clean.count()
    assert corpus_pipeline.without_repeated_lines(spark, clean, SF).where("text = ''").count() == 0
