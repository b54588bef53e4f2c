"""What dossiers shuffle: narrow facts, matches once, and documents where their sections lie."""

from __future__ import annotations

from lotlens.operators import dossier, wide
from lotlens.plans import valuation as v
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
COLUMNS = ["current_owner_name", "assessment_total_value", "tax_taxes", "assessment_acres"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_of_some_columns_equal_all_facts(spark):
    sources = v.fact_sources(spark, SF)
    full = wide.parcel_year_facts(**sources)
    for columns in (COLUMNS, ["payment_total_amount", "permit_event_count"]):
        some = wide.parcel_year_facts(**sources, columns=columns)
        assert some.columns == ["parcel_id", "year", *columns] and some.count() == full.count()
        assert full.select(some.columns).exceptAll(some).count() == 0
    plan = _plan(wide.parcel_year_facts(**sources, columns=COLUMNS))
    assert "improved_value#" in plan and "billing_address" not in plan.split("Exchange")[0]  # it ranks records, but does not travel with them


def test_documents_are_grouped_where_their_sections_lie(spark):
    head = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "parcel_id long, name string")
    rows = spark.createDataFrame([(1, 5), (1, 4), (None, 3), (7, 2)], "parcel_id long, id int")
    made = dossier.documents(head, {"rows": (rows, [F.asc("id")])}, most=5)
    plan = _plan(made)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 3, plan  # header, first rows, and counts
    assert sorted((r.name, [x.id for x in r.rows], r.n_rows) for r in made.collect()) == [("a", [4, 5], 2), ("b", [4, 5], 2), ("c", [], 0), ("d", [3], 1)]


def test_matches_are_dealt_once(spark):
    matches = spark.createDataFrame([(1, 1, 10, True, 0.9, 1, "a"), (1, 1, 11, False, 0.8, 2, "b")], "parcel_id long, txn int, match_id int, is_primary boolean, confidence double, match_rank int, match_method string")
    sales = spark.createDataFrame([(1, 5.0)], "txn int, price double")
    codes = spark.createDataFrame([(1, "z", True)], "txn int, exclusion_code string, is_active boolean")
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = dossier.matched_sales(matches, sales, codes)
        assert _plan(made).count("Exchange hashpartitioning") == 3 and [r.match_method for r in made.collect()] == ["a"]  # matches, sales, and codes
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
