from __future__ import annotations

import itertools

import numpy as np
import pytest

from lotlens.llm import packing


@pytest.mark.parametrize("seed", range(8))
def test_bounds_are_optimal(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 5, 12) * (rng.random(12) < 0.7)
    if not counts.sum():
        return
    used = np.flatnonzero(counts)
    waste = lambda bs: sum(int(counts[n]) * (min(b for b in bs if b >= n) - int(n)) for n in used)
    last = max(1, int(used[-1]))
    for k in (1, 2, 3):
        best = min(waste([*c, last]) for m in range(k) for c in itertools.combinations(range(1, last), m))
        got = packing.best_bounds(counts, k)
        assert got[-1] == last and len(got) <= k and waste(got) == best


def test_every_sequence_once_within_budget(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = packing.pack(docs, max_tokens=100, buckets=4, budget=1000).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    joined = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["piece"])):
        joined[r["doc_id"]] = joined.get(r["doc_id"], "") + r["text"]
        assert r["n_tokens"] == len(r["text"].encode().split()) <= r["bucket_tokens"] == r["n_tokens"] + r["padding"]
    assert joined == texts
    seats = [(r["bucket"], r["batch"], r["slot"]) for r in got]
    assert len(set(seats)) == len(seats)
    for bucket in {r["bucket"] for r in got}:
        own = [r for r in got if r["bucket"] == bucket]
        room = max(1, 1000 // own[0]["bucket_tokens"])
        assert sorted((r["batch"], r["slot"]) for r in own) == [(i // room, i % room) for i in range(len(own))]
    light = packing.pack(docs, max_tokens=100, buckets=4, budget=1000, with_text=False)
    assert "text" not in light.columns and sorted((r["doc_id"], r["piece"], r["batch"], r["slot"]) for r in light.collect()) != []


def test_odd_rows(odd, none):
    got = packing.pack(odd).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in odd.collect()}
    assert sum(r["n_tokens"] for r in got) == sum(len((r["text"] or "").encode().split()) for r in odd.collect())
    assert [r["n_tokens"] for r in got if r["doc_id"] in (0, 1, 2)] == [0, 0, 0]
    assert packing.pack(none).count() == 0
