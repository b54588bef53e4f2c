from __future__ import annotations

from pyspark.sql import functions as F

from lotlens.operators import facts, order, review
from lotlens.sources import imports


def test_bad_json_is_a_row(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"run": {"id": "r1"}, "n": 3}')
    (tmp_path / "b.json").write_text("{broken")
    got = imports.json_artifacts(spark, str(tmp_path), "run struct<id: string>, n long")
    rows = {r["file_path"].rsplit("/", 1)[1]: (r["n"], r["_corrupt_record"] is not None) for r in got.collect()}
    assert rows == {"a.json": (3, False), "b.json": (None, True)}


def test_formula_safe(spark):
    df = spark.createDataFrame([(" =1+1", True, None), ("-x", None, 2), ("ok", False, -3)], "t string, b boolean, n int")
    assert sorted(tuple(r) for r in review.formula_safe(df).collect()) == [("' =1+1", "true", ""), ("'-x", "", "2"), ("ok", "false", "-3")]


def test_scopes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert facts.key_scope(df, None, "k").count() == 2
    assert facts.key_scope(df, df.where("false"), "k").count() == 0
    got = facts.replace_scope(df, spark.createDataFrame([(2, "new")], "k int, v string"), F.col("k") == 2)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a"), (2, "new")]


def test_as_of_takes_the_latest_not_after(spark):
    checks = spark.createDataFrame([("p", 5), ("p", 1), ("q", 9)], "p string, at int")
    events = spark.createDataFrame([("p", 2), ("p", 5), ("p", 6)], "p string, at int")
    assert sorted(map(repr, (tuple(r) for r in order.as_of(checks, events, ["p"], "at").collect()))) == ["('p', 1, None)", "('p', 5, 5)", "('q', 9, None)"]
