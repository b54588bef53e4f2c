"""Keyed tables: versions, scopes, failures, conflicts and clearing."""

from __future__ import annotations

from pathlib import Path

import pytest
from lotlens.sources.tables import BUCKET, Conflict, KeyedTable
from pyspark.sql import functions as F


@pytest.fixture()
def target(spark, tmp_path):
    return KeyedTable(spark, f"file://{tmp_path}/t", ["k", "y"], ["k"], buckets=8)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, y int, v string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(target):
    return {p for p in Path(target.root.removeprefix("file://")).glob("data/*/*/*.parquet")}


def test_upsert_counts_and_old_versions(spark, target):
    assert target.read() is None and target.version() is None
    first = frame(spark, [(1, 1, "a"), (1, 2, "b"), (None, 1, "n"), (2, None, "m")])
    assert target.upsert(first).counts == {"inserted": 4, "updated": 0}
    second = frame(spark, [(1, 2, "B"), (None, 1, "N"), (3, 1, "c")])
    assert target.upsert(second).counts == {"inserted": 1, "updated": 2}
    assert rows_of(target.read()) == sorted([(1, 1, "a"), (1, 2, "B"), (None, 1, "N"), (2, None, "m"), (3, 1, "c")], key=repr)
    assert rows_of(target.read(1)) == rows_of(first) and target.read(9) is None


def test_untouched_buckets_keep_their_files(spark, target):
    target.upsert(frame(spark, [(k, 1, "a") for k in range(200)]))
    before, folders = files(target), target.version().folders
    target.upsert(frame(spark, [(7, 1, "b")]))
    changed = {b for b, f in target.version().folders.items() if f != folders[b]}
    assert len(changed) == 1 and before <= files(target)
    assert len({p for p in files(target) - before}) >= 1 and all(p.parent.name == f"{BUCKET}={next(iter(changed))}" for p in files(target) - before)


def test_scoped_replace(spark, target):
    target.upsert(frame(spark, [(k, y, "a") for k in (1, 2, 3) for y in (1, 2)] + [(None, 1, "n")]))
    scope = spark.createDataFrame([(1,), (None,), (9,)], "k long")
    assert target.replace(scope, frame(spark, [(1, 5, "new"), (9, 1, "new")])).counts == {"deleted": 3, "inserted": 2}
    assert rows_of(target.read()) == sorted([(2, 1, "a"), (2, 2, "a"), (3, 1, "a"), (3, 2, "a"), (1, 5, "new"), (9, 1, "new")], key=repr)
    with pytest.raises(ValueError):
        target.replace(scope, frame(spark, [(2, 1, "outside")]))
    assert target.replace(scope.where("false"), frame(spark, [])).counts == {"deleted": 0, "inserted": 0}
    assert len(rows_of(target.read())) == 6


def test_a_failed_write_leaves_the_old_version(spark, target):
    target.upsert(frame(spark, [(1, 1, "a")]))

    @F.udf("string")
    def broken(v):
        raise RuntimeError("executor says no")

    with pytest.raises(Exception, match="executor says no"):
        target.upsert(frame(spark, [(1, 1, "b"), (2, 1, "c")]).withColumn("v", broken("v")))
    assert target.versions() == [1] and rows_of(target.read()) == [(1, 1, "a")]
    target.upsert(frame(spark, [(1, 1, "b"), (2, 1, "c")]))
    assert rows_of(target.read()) == [(1, 1, "b"), (2, 1, "c")]
    # what the failed try left is named by no version and goes with the versions before the last
    gone = target.vacuum(keep=1)
    assert any(g.startswith("versions/") for g in gone) and target.versions() == [2]
    assert rows_of(target.read()) == [(1, 1, "b"), (2, 1, "c")] and {p.parent.parent.name for p in files(target)} == set(target.version().folders.values())


def test_a_repeated_batch_changes_nothing(spark, target):
    rows = frame(spark, [(1, 1, "a")])
    a = target.upsert(rows, token="batch 0")
    assert target.upsert(frame(spark, [(1, 1, "other")]), token="batch 0") == a and target.versions() == [1]
    target.replace(rows.select("k"), rows, token="batch 1")
    assert target.replace(rows.select("k"), frame(spark, []), token="batch 1").number == 2 and rows_of(target.read()) == [(1, 1, "a")]


def test_of_two_writers_one_fails(spark, target):
    target.upsert(frame(spark, [(1, 1, "a")]))
    old = target.version()
    target.upsert(frame(spark, [(1, 1, "b")]))
    with pytest.raises(Conflict):
        target._replaced(old, {0}, frame(spark, []), None, {})
    assert rows_of(target.read()) == [(1, 1, "b")]


def test_columns(spark, target):
    target.upsert(frame(spark, [(1, 1, "a")]).select("v", "y", "k", F.lit(0.5).alias("a b")))
    target.upsert(spark.createDataFrame([(2, 1)], "y int, k int"))
    assert target.read().columns == ["v", "y", "k", "a b"] and rows_of(target.read()) == sorted([("a", 1, 1, 0.5), (None, 2, 1, None)], key=repr)
    with pytest.raises(ValueError):
        target.upsert(frame(spark, [(1, 1, "a")]).withColumn("more", F.lit(1)))
    with pytest.raises(ValueError):
        KeyedTable(spark, "x", ["a"], ["b"])


def test_scratch_is_cleared(spark):
    from lotlens import runtime

    kept = runtime.cut(spark.range(3).toDF("k"))
    folder = Path(runtime.scratch(spark, "x").removeprefix("file:")).parent
    assert kept.count() == 3 and any(folder.iterdir())
    runtime.clear_scratch(spark)
    assert not folder.exists()
    runtime.clear_scratch(spark)
    assert runtime.cut(spark.range(2).toDF("k")).count() == 2
