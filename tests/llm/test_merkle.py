"""Merkle manifests against a plain tree."""

from __future__ import annotations

import hashlib

import pytest
from lotlens.llm import merkle
from pyspark.sql import functions as F


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def climb(level, at):
    """(siblings up to the root, root) of a leaf of a plain tree of hex digests."""
    siblings = []
    while len(level) > 1:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        siblings += run[: at % 8] + run[at % 8 + 1 :]
        level, at = [H("".join(level[k : k + 8])) for k in range(0, len(level), 8)], at // 8
    return siblings, level[0]


def plain(rows):
    """rows (group, key, leaf) -> {(group, key, leaf): (proof, subroot, root)}"""
    groups = {}
    for g, k, leaf in sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(g, []).append((k, leaf))
    tops = [climb([leaf for _, leaf in own], 0)[1] for own in groups.values()]
    out = {}
    for n, (g, own) in enumerate(groups.items()):
        above, root = climb(tops, n)
        for at, (k, leaf) in enumerate(own):
            inside, sub = climb([x for _, x in own], at)
            out.setdefault((g, k, leaf), []).append((tuple(inside + above), sub, root))
    return out


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 9, None: 1, "": 8, "de": 65}, {f"l{k}": 1 + k % 3 for k in range(30)}, {"en": 600, "é": 64, "z": 513}])
def test_tree_equals_plain(spark, sizes):
    rows = [(g, k * 7 % 997, H(f"{g}{k}")) for g, n in sizes.items() for k in range(n)]
    table = spark.createDataFrame(rows, "lang string, doc_id long, hex string").repartition(3)
    table = table.select("lang", "doc_id", F.unhex("hex").alias("leaf"), F.when(F.col("doc_id") % 3 == 0, F.unhex(F.sha2("hex", 256))).otherwise(F.unhex("hex")).alias("shown"))
    made = merkle.build(table, "lang", "doc_id", keep=["shown"])
    found = merkle.prove(made, "shown").collect()
    want = plain(rows)
    assert len(found) == len(rows)
    for r in found:
        ((proof, sub, root),) = want[r.lang, r.doc_id, bytes(r.leaf).hex()]
        assert bytes(r.proof).hex() == "".join(proof) and bytes(r.subroot).hex() == sub and made.root.hex() == root
        assert (bytes(r.folded) == made.root) == (r.doc_id % 3 != 0)


def test_nulls_repeats_and_empty(spark, odd):
    leaf = merkle.leaf_of([F.col("doc_id"), F.col("text")])
    table = odd.select("doc_id", "lang", leaf.alias("leaf"))
    table = table.unionByName(table)
    made = merkle.build(table, "lang", "doc_id")
    found = merkle.prove(made, "leaf").collect()
    rows = [(r.lang, r.doc_id, bytes(r.leaf).hex()) for r in table.collect()]
    want = plain(rows)
    assert len(found) == len(rows) and all(bytes(r.folded) == made.root for r in found)
    for r in found:
        assert tuple(bytes(r.proof).hex()[k : k + 64] for k in range(0, 2 * len(r.proof), 64)) in {p for p, _, _ in want[r.lang, r.doc_id, bytes(r.leaf).hex()]}
    none = merkle.build(table.where("false"), "lang", "doc_id")
    assert none.root is None and merkle.prove(none, "leaf").count() == 0


def test_encoding_and_limits(spark):
    row = spark.createDataFrame([(1, None, "é", "")], "a long, b string, c string, d string")
    assert bytes(row.select(merkle.leaf_of([F.col(c) for c in "abcd"])).first()[0]).hex() == H("1:1-2:é0:")
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    table = spark.range(20).select(F.lit("x").alias("g"), "id", F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("leaf"))
    merkle.prove(merkle.build(table, "g", "id"), "leaf", key="id").count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
