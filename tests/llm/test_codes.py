"""Vector codes against plain loops over all entries."""

from __future__ import annotations

import math

import numpy as np
import pytest
from lotlens.llm import codes


def plain(vectors, entries=64, rounds=2, parts=16):
    """(codebooks, codes, errors) of integer vectors in the order of their keys, by whole distance tables."""
    x = np.asarray(vectors).reshape(len(vectors), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def near():
        d = ((x.transpose(1, 0, 2)[:, :, None] - books[:, None]) ** 2).sum(-1)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        own = near()[0]
        for p in range(parts):
            for e in range(books.shape[1]):
                if (own[p] == e).any():
                    books[p, e] = x[own[p] == e, p].sum(0) // (own[p] == e).sum()
    own, d = near()
    return books, ["".join(f"{e:02x}" for e in own[:, k]) for k in range(len(x))], d.sum(0).tolist()


@pytest.mark.parametrize("kind", ["spread", "grid", "few", "same", "one"])
def test_trees_are_exact(kind):
    rng = np.random.default_rng(5)
    points = {"spread": rng.normal(0, 200, (900, 4)), "grid": rng.integers(-3, 3, (3000, 4)), "few": rng.integers(-1, 2, (40, 2)), "same": np.full((500, 3), 7), "one": rng.integers(0, 9, (1, 5))}[kind]
    points = np.floor(points).astype(np.int64)
    for entries in (points[rng.integers(0, len(points), 64)], rng.integers(-300, 300, (64, points.shape[1])), points[:1]):
        tree = codes.Tree.unpack(codes.tree_of(points).pack())
        owner, sums, counts = codes.nearest(tree, entries)
        want = ((points[:, None] - entries[None]) ** 2).sum(-1).argmin(1)
        assert (owner[tree.row_point] == want).all()
        for e in range(len(entries)):
            assert counts[e] == (want == e).sum() and (sums[e] == points[want == e].sum(0)).all()


def test_balls_hold_their_points():
    points = np.random.default_rng(1).integers(-500, 500, (2000, 4))
    tree = codes.tree_of(points)
    assert (tree.points[tree.row_point] == points).all() and tree.count[0] == 2000
    for k in range(len(tree.radius)):
        own, w = tree.points[tree.first[k] : tree.last[k]], tree.weight[tree.first[k] : tree.last[k]]
        assert (tree.total[k] == (own * w[:, None]).sum(0)).all() and tree.count[k] == w.sum()
        assert np.sqrt(((own - tree.center[k]) ** 2).sum(1)).max() <= tree.radius[k] + 1e-9
        if tree.left[k] >= 0:
            a, b = tree.left[k], tree.right[k]
            assert (tree.first[a], tree.last[a], tree.last[b]) == (tree.first[k], tree.first[b], tree.last[k])
    assert len(tree.radius) > 100


@pytest.mark.parametrize("rows, block", [(300, 64), (40, 2048)])
def test_codes_equal_plain(spark, monkeypatch, rows, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    rng = np.random.default_rng(rows)
    given = rng.normal(0, 1, (rows, 32)).astype(np.float32)
    given[rows // 2 :: 3] = given[0]
    table = spark.createDataFrame([(k, v.tolist(), k % 3 or None) for k, v in enumerate(given)], "vec_id long, embedding array<float>, label int").repartition(5)
    model = codes.learn(table, keep=("label",))
    books, text, error = plain(np.floor(given.astype(float) * 256).astype(np.int64))
    assert (model.codebooks == books).all()
    found = codes.decode(codes.encode(model), model).orderBy("vec_id").collect()
    assert [(r.vec_id, r.label, r.code, r.error) for r in found] == [(k, k % 3 or None, t, e) for k, (t, e) in enumerate(zip(text, error, strict=True))]
    for r in found:
        own = np.concatenate([books[p][int(r.code[2 * p : 2 * p + 2], 16)] for p in range(16)]) / 256
        assert r.vector == own.tolist()


def test_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, None), (2, []), (3, [1.0, None] * 8), (4, [nan] * 16), (5, [inf] * 16), (6, [0.5] * 16), (6, [0.5] * 16), (None, [1e30] * 16), (7, [-0.001] * 10), (8, [2.0] * 17)]
    table = spark.createDataFrame([(k, v, "x") for k, v in rows], "vec_id long, embedding array<double>, row string")
    model = codes.learn(table, keep=("row",))
    found = codes.encode(model).collect()
    assert sorted((r.vec_id or 0) for r in found) == [0, 6, 6, 7, 8] and all(r.row == "x" and r.error == 0 for r in found)
    assert model.codebooks.shape == (16, 5, 2)  # 17 components fill 32
    edge = codes.largest_component(32)
    assert model.codebooks.max() == edge and 32 * (2 * edge) ** 2 <= 2**62
    none = codes.learn(table.where("false"))
    assert codes.encode(none).count() == 0 and none.codebooks.size == 0
