from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from lotlens.llm import lines

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, min_docs=5, min_chars=40):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    own = defaultdict(list)
    for i, (_, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_chars:
                own[k].append(i)
    out = []
    for doc_id, text in rows:
        kept, ls = [], (text or "").split("\n")
        for x in ls:
            holders = own.get(key(x), [])
            ids = [rows[i][0] for i in holders if rows[i][0] is not None]
            if not (len(holders) >= min_docs and max(ids, default=None) != doc_id):
                kept.append(x)
        out.append((doc_id, "\n".join(kept), len(ls), len(ls) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [1 << 27, 0])
def test_same_as_brute_force(odd, limit):
    got = lines.dedup_lines(odd, max_index_bytes=limit)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "key", "component", "n_lines", "n_dropped"]
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=repr) == brute(rows)
    assert sum(r["n_dropped"] for r in got.collect()) > 0


@pytest.mark.parametrize("limit", [1 << 27, 0])
def test_empty_table(none, limit):
    assert lines.dedup_lines(none, max_index_bytes=limit).count() == 0


def test_hot_shards_are_copied(odd, monkeypatch):
    """Many shards, and few lines a copy, so that each shard goes to several partitions."""
    monkeypatch.setattr(lines, "SHARD_KEYS", 1)
    monkeypatch.setattr(lines, "PROBES", 2)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = lines.dedup_lines(odd, max_index_bytes=0)
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=repr) == brute(rows)


def test_packed_shards():
    rng = np.random.default_rng(3)
    h1, h2 = (rng.integers(0, 2**63, 3000).astype(np.uint64) for _ in "ab")
    keep, n = rng.integers(0, 9, 3000), rng.integers(1, 9, 3000)
    packed = lines.Shard.of(h1, h2, n, keep).pack()
    assert len(packed) <= lines.KEY_BYTES * 3000 + 500
    shard = lines.Shard.unpack(packed)
    doc = rng.integers(0, 9, 3000)
    assert (shard.drops(h1, h2, doc, 5) == ((n >= 5) & (keep != doc))).all()
    assert not shard.drops(h1, h2 ^ np.uint64(1), doc, 1).any()


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
    keys = np.unique(keys)
    second = keys[::-1].copy()
    h = lines.PerfectHash.of(keys, second)
    assert sorted(h(keys, second).tolist()) == list(range(len(keys)))
    other = h(keys + np.uint64(1), second)
    assert ((other >= -1) & (other < max(1, len(keys)))).all()


@pytest.mark.parametrize("n", [2, 3, 400])
def test_equal_first_hashes_part_by_the_second(n):
    """Keys whose first hashes collide still get slots of their own; a pair that repeats is an error, not an endless loop."""
    h1 = np.r_[np.full(n, 5, np.uint64), np.arange(100, 200, dtype=np.uint64)]
    h2 = np.arange(len(h1), dtype=np.uint64)
    keep, count = np.arange(len(h1)), np.full(len(h1), 7)
    shard = lines.Shard.unpack(lines.Shard.of(h1, h2, count, keep).pack())
    assert not shard.drops(h1, h2, keep, 5).any() and shard.drops(h1, h2, keep + 1, 5).all()
    assert not shard.drops(h1, h2 + np.uint64(10_000), keep, 5).any()
    with pytest.raises(ValueError):
        lines.PerfectHash.of(np.array([5, 5, 9], np.uint64), np.array([1, 1, 1], np.uint64))


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in lines.dedup_lines(docs, min_docs=2).collect()), key=repr)
    assert got == brute(rows, min_docs=2)
