from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lotlens.llm import components, simhash


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    spans = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(fps, most):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= most:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_fingerprints(odd):
    for r in odd.select("text").collect():
        if r["text"] is None or len(r["text"]) < 5000:
            assert simhash.fingerprint(r["text"]) == plain_fingerprint(r["text"])


def test_components_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    ids = sorted(got)
    fps = [got[i]["fp"] & (2**64 - 1) for i in ids]
    least = {}
    for i, c in zip(ids, classes(fps, 3), strict=True):
        least.setdefault(c, i)
    assert [got[i]["component"] for i in ids] == [least[c] for c in classes(fps, 3)]
    assert sum(got[i]["component"] != i for i in ids) > 3


@pytest.mark.parametrize("most", [2, 3, 5])
def test_links_of_dense_clusters(spark, most, monkeypatch):
    """A dense cluster over few bits, chains and noise; small blocks, so that heavy segments are dealt to pairs of blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 64)
    rng = np.random.default_rng(most)
    base = rng.integers(0, 2**63, 4, dtype=np.int64).astype(np.uint64)
    dense = base[0] ^ (rng.integers(0, 2**10, 300).astype(np.uint64) << np.uint64(28))
    chain = [base[1]]
    for _ in range(30):
        flips = rng.choice(64, most, replace=False)
        chain.append(chain[-1] ^ np.uint64(sum(1 << int(b) for b in flips)))
    fps = np.unique(np.concatenate([dense, np.array(chain, np.uint64), rng.integers(0, 2**63, 200).astype(np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.links(df, "fp", most).collect()]
    assert all(bin(a ^ b).count("1") <= most for a, b in edges)
    at = {int(x): i for i, x in enumerate(fps)}
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(at[a])] = find(at[b])
    ours, want = [find(i) for i in range(len(fps))], classes([int(x) for x in fps], most)
    assert len(set(zip(ours, want, strict=True))) == len(set(ours)) == len(set(want))


def test_components_of_star_chain_and_ring(spark):
    edges = [(0, i) for i in range(1, 40)] + [(100 + i, 101 + i) for i in range(60)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).groupBy("root").agg(F.count("*").alias("n"), F.min("node").alias("m"))
    assert sorted((r["m"], r["n"]) for r in got.collect()) == [(0, 40), (100, 61), (200, 9)]
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows_and_empty(odd, none):
    got = simhash.near_duplicates(odd)
    rows = got.collect()
    assert len(rows) == odd.count() and got.columns == ["doc_id", "fp", "component"]
    blank = [r for r in rows if r["doc_id"] in (0, 1, 2)]
    assert {(r["fp"], r["component"]) for r in blank} == {(0, 0)}
    assert {r["component"] for r in rows if r["doc_id"] in (10, 11, 12)} == {10}
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect() if r["doc_id"] is not None))
    assert 0 in ids and 1 not in ids and ids.count(5) == 2 and 12 not in ids
    assert kept.where("doc_id is null").count() == 1
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_first(none).count() == 0
    by_shuffle = simhash.keep_first(odd, max_broadcast_bytes=0)
    assert sorted(map(repr, by_shuffle.collect())) == sorted(map(repr, kept.collect()))


def test_similar_documents_are_verified(spark):
    """Copies with few changed words join their source; copies with many changes and other texts stay alone."""
    rng = np.random.default_rng(8)
    vocab = np.array([f"w{i}" for i in range(400)])
    rows, near, far = [], [], []
    for k in range(60):
        words = rng.choice(vocab, 400)
        rows.append((10 * k, " ".join(words)))
        changed = words.copy()
        changed[rng.choice(400, 3, replace=False)] = "new"
        rows.append((10 * k + 1, " ".join(changed).upper()))
        near.append(10 * k + 1)
        changed = words.copy()
        changed[rng.choice(400, 60, replace=False)] = "other"
        rows.append((10 * k + 2, " ".join(changed)))
        far.append(10 * k + 2)
        rows.append((10 * k + 3, " ".join(words)))
    sets = {i: set(simhash.shingle_set(t, 5).tolist()) for i, t in rows}
    got = {r["doc_id"]: r["component"] for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == i for i in far) and all(got[10 * k + 3] == 10 * k for k in range(60))
    for i, c in got.items():
        assert i == c or len(sets[i] & sets[c]) >= 0.8 * len(sets[i] | sets[c])
    assert sum(got[i] != i for i in near) == 60


@pytest.mark.parametrize("block", [128, 2048])
def test_large_groups_lose_no_similar_pair(spark, monkeypatch, block):
    """One base and hundreds of variants at all distances, so that many links fail: the groups of all pairs, by brute force."""
    monkeypatch.setattr(simhash, "GROUP_BLOCK", block)
    rng = np.random.default_rng(5)
    base = np.array([f"w{i}" for i in rng.integers(0, 400, 300)], object)
    rows = []
    for i in range(400):
        words = base.copy()
        n = int(rng.integers(1, 16))
        words[rng.choice(300, n, replace=False)] = [f"v{i}x{k}" for k in range(n)]
        rows.append((i, " ".join(words)))
    wide = np.array([simhash.word_prints(t)[:2] for _, t in rows], np.uint64)
    sets = [set(simhash.shingle_set(t, 5).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (np.sort(np.bitwise_count(wide[i] ^ wide[j])) <= (7, 16)).all() and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r["component"] for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = [find(i) for i in range(len(rows))]
    assert 16 < max(want.count(k) for k in want) < len(rows)
    assert [got[i] for i in range(len(rows))] == want


def test_equal_fingerprints_are_verified(spark):
    """A filler that fills the fingerprint does not make different texts copies; equal words and equal sets do."""
    clean = [" ".join(f"c{k}x{i}" for i in range(100)) for k in range(6)]
    rows = [(k, f"{'na ' * 300}{t}") for k, t in enumerate(clean)]
    rows += [(10 + k, f"{'NA ' * 300} {t}\n") for k, t in enumerate(clean)] + [(20 + k, f"{'na ' * 310}{t}") for k, t in enumerate(clean)]
    rows += [(20, "another text under an id that is there twice")]
    got = sorted((r["doc_id"], r["component"]) for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(i, i % 10) for i, _ in rows[:18]] + [(20, 20)])
