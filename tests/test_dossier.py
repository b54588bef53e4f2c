"""Nested dossiers of hand-made parcels."""

from __future__ import annotations

import datetime

from lotlens.operators import dossier
from pyspark.sql import functions as F


def test_facts_fill_years_without_assessments(spark):
    own = spark.createDataFrame([(1, "p", 2024, 5.0), (2, "p", 2024, 6.0), (3, "p", None, 7.0), (4, "q", 2023, 8.0)], "assessment_id long, parcel_id string, year int, total double")
    facts = spark.createDataFrame([("p", 2024, 1.0), ("p", 2023, 2.0), ("q", 2022, 3.0)], "parcel_id string, year int, total double")
    got = {(r.parcel_id, r.year, r.assessment_id, r.total) for r in dossier.assessment_history(own, facts).collect()}
    assert got == {("p", 2024, 1, 5.0), ("p", 2024, 2, 6.0), ("p", None, 3, 7.0), ("q", 2023, 4, 8.0), ("p", 2023, None, 2.0), ("q", 2022, None, 3.0)}


def test_a_sale_is_shown_by_its_best_match(spark):
    matches = spark.createDataFrame([
        ("p", 1, 10, False, 0.9, 1, "a"), ("p", 1, 11, True, 0.8, 2, "b"), ("p", 2, 12, None, None, 1, "c"), ("p", 2, 13, False, 0.1, None, "d"), ("p", 3, 14, None, None, 2, "e"), ("p", 3, 15, None, None, 1, "f"), ("q", 1, 16, None, None, None, "g"), ("p", 9, 17, True, 1.0, 1, "no sale"),
    ], "parcel_id string, txn int, match_id int, is_primary boolean, confidence double, match_rank int, match_method string")
    sales = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "txn int, price double")
    codes = spark.createDataFrame([(1, "z", True), (1, "a", True), (1, "a", True), (2, "b", False)], "txn int, exclusion_code string, is_active boolean")
    got = {(r.parcel_id, r.txn): (r.match_method, r.price, r.exclusion_codes) for r in dossier.matched_sales(matches, sales, codes).collect()}
    assert got == {("p", 1): ("b", 5.0, ["a", "z"]), ("p", 2): ("d", 6.0, []), ("p", 3): ("f", 7.0, []), ("q", 1): ("g", 5.0, ["a", "z"])}


def test_documents_hold_the_first_rows_and_count_all(spark):
    head = spark.createDataFrame([("hot", "x"), ("few", "y"), ("none", None)], "parcel_id string, name string")
    many = spark.range(1000).select(F.lit("hot").alias("parcel_id"), "id", (F.col("id") % 10).cast("int").alias("year")).unionByName(spark.createDataFrame([("few", 5, None), ("few", 6, 2000), ("stranger", 1, 1)], "parcel_id string, id long, year int"))
    notes = spark.createDataFrame([("few", "a", 1.5)], "parcel_id string, text string, `odd name` double")
    got = {r.parcel_id: r for r in dossier.documents(head, {"events": (many, [F.desc_nulls_last("year"), F.desc("id")]), "notes": (notes, [F.asc("text")])}, most=3).collect()}
    assert set(got) == {"hot", "few", "none"}
    assert [(r.id, r.year) for r in got["hot"].events] == [(999, 9), (989, 9), (979, 9)] and got["hot"].n_events == 1000 and (got["hot"].notes, got["hot"].n_notes) == ([], 0)
    assert [(r.id, r.year) for r in got["few"].events] == [(6, 2000), (5, None)] and got["few"].notes[0]["odd name"] == 1.5 and got["few"].name == "y"
    assert (got["none"].events, got["none"].n_events, got["none"].notes) == ([], 0, [])



def test_a_parcel_with_many_rows_is_cut_before_the_shuffle(spark):
    rows = spark.range(100).select(F.lit("p").alias("parcel_id"), "id").withColumn("parcel_id", F.concat("parcel_id", (F.col("id") % 2).cast("string")))
    made = dossier.documents(rows.select("parcel_id").distinct(), {"events": (rows, [F.asc("id")])}, most=2)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan  # by each task, and after the shuffle


def test_timeline_of_one_day(spark):
    """Newest first, undated last; of one day scores, appeals, permits, sales and assessments."""
    df = spark.createDataFrame([("p", 1, datetime.date(2024, 12, 31), 2024, 1.0)], "p string, id int, d date, y int, a double")
    one = lambda kind, day=F.col("d"), y=F.col("y"): dossier.event(df, kind, F.col("p"), F.col("id"), day, y, F.col("a"))
    none, no_year = F.lit(None).cast("date"), F.lit(None).cast("int")
    parts = [one("assessment"), one("sale"), one("permit"), one("appeal"), one("score", none), one("permit", none, no_year), one("assessment", none)]
    got = [(r.event_type, r.event_date and r.event_date.isoformat()) for r in dossier.timeline(*parts).orderBy("position").collect()]
    assert got == [(k, "2024-12-31") for k in ("score", "appeal", "permit", "sale", "assessment")] + [("assessment", "2024-01-01"), ("permit", None)]


def test_header_of_the_newest_fact(spark):
    parcels = spark.createDataFrame([("p", "t1"), ("q", "t2")], "parcel_id string, trs string")
    facts = spark.createDataFrame([("p", 2023, "old", "o"), ("p", 2024, "new", None)], "parcel_id string, year int, owner string, address string")
    assert sorted(tuple(r) for r in dossier.fact_header(parcels, facts, ["owner", "address"]).collect()) == [("p", "t1", "new", None), ("q", "t2", None, None)]
