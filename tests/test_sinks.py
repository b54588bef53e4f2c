"""CSV files of queues and metric series: exact texts, fixed columns, reruns."""

from __future__ import annotations

import datetime

import pytest
from lotlens.operators import monitor
from lotlens.sources import sinks
from pyspark.sql import functions as F


def queue(spark, rows):
    """rows (rank, run, municipality)"""
    df = spark.createDataFrame(rows, "queue_rank long, run_id string, municipality_name string")
    own = df.columns
    return df.select(*[F.col(c) if c in own else (F.lit(True) if c == "requires_review" else F.lit(None).cast("string")).alias(c) for c in sinks.QUEUE_COLUMNS], F.lit("not written").alias("more"))


def test_texts_come_back_as_they_were(spark, tmp_path):
    odd = ["plain", "", None, " ends ", 'a "quoted", text', "two\nlines", "=1+1", "  @cmd", "-5", "it's", "tab\t", "\\", "é|ß", "NULL"]
    sinks.write_queue(queue(spark, [(k, "r", t) for k, t in enumerate(odd)]), str(tmp_path / "q"))
    got = sinks.read_queue(spark, str(tmp_path / "q"))
    assert got.columns == sinks.QUEUE_COLUMNS
    found = {int(r.queue_rank): r for r in got.collect()}
    want = ["plain", "", "", " ends ", 'a "quoted", text', "two\nlines", "'=1+1", "'  @cmd", "'-5", "it's", "tab\t", "\\", "é|ß", "NULL"]
    assert [found[k].municipality_name for k in range(len(odd))] == want
    assert {(r.requires_review, r.run_id, r.score_id) for r in found.values()} == {("true", "r", "")}


def test_a_rerun_replaces_its_own_files(spark, tmp_path):
    folder = str(tmp_path / "q")
    sinks.write_queue(queue(spark, [(1, "a", "x"), (2, "a", "y")]), folder)
    kept = {p.name for p in (tmp_path / "q").rglob("of_run_id=a/*.csv")}
    sinks.write_queue(queue(spark, [(1, "b", "x"), (2, "b", "y")]), folder)
    sinks.write_queue(queue(spark, [(1, "b", "z")]), folder)
    assert sorted((r.run_id, r.municipality_name) for r in sinks.read_queue(spark, folder).collect()) == [("a", "x"), ("a", "y"), ("b", "z")]
    assert {p.name for p in (tmp_path / "q").rglob("of_run_id=a/*.csv")} == kept
    with pytest.raises(ValueError, match="dossier_year"):
        sinks.write_queue(queue(spark, [(1, "b", "z")]).drop("dossier_year"), folder)


def test_metric_records(spark):
    now = datetime.datetime(2024, 1, 31)
    at = lambda **ago: now - datetime.timedelta(**ago)
    events = [("a", at(minutes=30), True, "p"), ("a", at(hours=5), False, "p"), ("a", at(days=20), True, "q"), ("a", at(days=300), False, None), ("a", at(days=400), False, None), ("b", at(days=300), False, None), ("unknown", now, True, None)]
    df = spark.createDataFrame(events, "sli string, observed_at timestamp, passed boolean, profile_name string")
    targets = spark.createDataFrame([("a", "d1", None, 0.5, "28d"), ("b", "d2", "own", 0.9, "28d")], "sli string, domain string, profile_name string, target double, window string")
    got = monitor.metric_records(df, F.lit(now), "test", targets).collect()
    rows = {(r.metric_id, r.window): (r.value, r.numerator, r.denominator) for r in got if r.window != "event"}
    assert rows["a.compliance", "1h"] == (1.0, 1, 1) and rows["a.compliance", "6h"] == (0.5, 1, 2) and rows["a.compliance", "28d"] == (0.666667, 2, 3) and rows["a.compliance", "365d"] == (0.5, 2, 4)
    assert rows["b.compliance", "28d"] == (None, 0, 0) and rows["b.compliance", "365d"] == (0.0, 0, 1)
    assert rows["a.error_budget_remaining", "28d"] == (0.333333, None, None) and rows["b.error_budget_remaining", "28d"] == (1.0, None, None)
    each = [r for r in got if r.window == "event"]
    assert len(each) == 6 and {(r.metric_id, r.value, r.numerator, r.denominator) for r in each} == {("a.event", 1.0, 1, 1), ("a.event", 0.0, 0, 1), ("b.event", 0.0, 0, 1)}
    assert {r.profile_name for r in got if r.metric_id == "b.compliance"} == {"own"}
