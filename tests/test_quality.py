"""Data-quality checks on small hand-made rows, codes and exclusive branches."""

from __future__ import annotations

import datetime

import pytest
from lotlens.operators import match, pick, quality
from pyspark.sql import functions as F

TODAY = datetime.date(2026, 3, 1)
SCHEMA = "id long, parcel_id string, year int, valuation_date date, valuation_classification string, assessment_acres double, land_value double, improved_value double, total_value double"


def assessments(spark, rows):
    """rows (id, parcel, year, date, total)"""
    return spark.createDataFrame([(i, p, y, d and datetime.date.fromisoformat(d), None, 1.0, 2.0, None, t) for i, p, y, d, t in rows], SCHEMA)


def codes(df):
    return sorted((r.key, r.code) for r in df.collect())


def test_dates_get_the_first_code_that_holds(spark):
    rows = [
        (1, "p", 2020, "2027-01-01", 9.0), (2, "p", 2020, "2021-01-01", 9.0), (3, "p", 2020, "2015-12-31", 9.0), (4, "p", 2020, "2016-01-01", 9.0), (5, "p", None, "2027-01-01", 9.0), (6, "p", None, "1990-01-01", 9.0), (7, "p", 2020, None, 9.0),
    ]
    got = codes(quality.suspicious_dates(assessments(spark, rows), F.col("id"), F.lit(TODAY)))
    assert got == [("1", "future_assessment_date"), ("2", "assessment_date_after_year"), ("3", "stale_assessment_date"), ("5", "future_assessment_date")]


def test_values_carried_for_five_years_are_not_stale(spark):
    old = "2000-01-01"
    five = [(k, "a", 2010 + k, old, 9.0) for k in range(5)]  # a run of five
    four = [(10 + k, "b", 2010 + k, old, 9.0) for k in range(4)]
    gap = [(20 + k, "c", 2010 + k + (k > 2), old, 9.0) for k in range(5)]
    changed = [(30 + k, "d", 2010 + k, old, 9.0 if k < 4 else 8.0) for k in range(5)]
    twice = [(40 + k, "e", 2010 + k // 2, old, 9.0) for k in range(8)]  # four years, two rows each
    fine = [(50 + k, "f", 2010 + k // 2, old, None) for k in range(10)]  # five years, unknown totals are alike
    got = codes(quality.suspicious_dates(assessments(spark, five + four + gap + changed + twice + fine), F.col("id"), F.lit(TODAY)))
    assert {int(k) for k, _ in got} == {*range(10, 14), *range(20, 25), *range(30, 35), *range(40, 48)} and {c for _, c in got} == {"stale_assessment_date"}


def test_runs_are_brought_back_in_one_shuffle(spark):
    df = spark.createDataFrame([("a", 2000 + k, "x") for k in range(3)] + [("a", 2004, "x"), ("a", None, "x"), (None, 2000, None), (None, 2001, None)], "p string, y int, v string")
    got = pick.in_long_run(df, ["p", "v"], "y", 2)
    assert sorted((str(r.p), r.y or 0, r.in_run) for r in got.collect()) == [("None", 2000, True), ("None", 2001, True), ("a", 0, False), ("a", 2000, True), ("a", 2001, True), ("a", 2002, True), ("a", 2004, False)]
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_impossible_numbers(spark):
    rows = [(1, "p", 2020, None, -1.0, -2.0, -3.0, -4.0), (2, "p", 2020, None, 1.0, 5.0, 6.0, 10.0), (3, "p", 2020, None, None, 5.0, None, 1.0), (4, "p", 2020, None, 1.0, 5.0, 5.0, 10.0)]
    df = spark.createDataFrame([(i, p, y, None, c, *v) for i, p, y, c, *v in rows], SCHEMA)
    assert codes(quality.impossible_assessments(df, F.col("id"))) == [("1", "negative_assessment_value")] * 4 + [("2", "assessment_total_less_than_components")]
    assert codes(quality.negative_amounts(df, F.col("id"), F.col("total_value") < 0, "tax")) == [("1", "negative_tax_amount")]


def test_lineage_and_duplicates(spark):
    links = spark.createDataFrame([("a", "b", "parent"), ("a", "b", "child"), ("c", "c", "parent"), ("d", "e", "cousin"), ("f", "g", None), ("f", "g", "child"), ("h", "i", "child"), ("h", "i", "child")], "p string, r string, kind string")
    got = codes(quality.lineage_consistency(links, "p", "r", "kind", ["parent", "child"]))
    assert got == [
        ("a|b", "conflicting_lineage_relationship"), ("c|c", "self_referential_lineage_link"), ("d|e", "invalid_lineage_relationship_type"), ("f|g", "conflicting_lineage_relationship"), ("f|g", "invalid_lineage_relationship_type"),
    ]
    twice = spark.createDataFrame([("a",), ("a",), ("b",)], "parcel_id string")
    assert codes(quality.duplicate_summaries(twice)) == [("a", "duplicate_parcel_summary")]


def test_the_first_tier_that_hits_takes_all_its_candidates(spark):
    left = spark.createDataFrame([(1, "n1", "a1"), (2, "n9", "a1"), (3, None, "a2"), (4, None, None), (5, "n2", None)], "t int, n string, a string")
    right = spark.createDataFrame([("p", "n1", "a1"), ("q", "n2", "a1"), ("q", "n2", "a1"), ("r", None, "a2")], "p string, n2 string, a2 string")
    tiers = [(m, w, F.col(x), F.col(y)) for (m, w), x, y in zip(match.TIERS.items(), ("n", "n", "a", "a"), ("n2", "n2", "a2", "a2"), strict=True)]
    got = sorted((r.t, r.p, r.method, r.match_rank, r.is_primary, r.review_status) for r in match.cascade(left, right, "t", "p", tiers).collect())
    assert got == [
        (1, "p", "exact_parcel_number", 1, True, "auto_accepted"), (2, "p", "normalized_address", 1, False, "needs_review"), (2, "q", "normalized_address", 2, False, "needs_review"),
        (3, "r", "normalized_address", 1, True, "auto_accepted"), (5, "q", "exact_parcel_number", 1, True, "auto_accepted"),
    ]
    legal = match.cascade(left, right, "t", "p", [("normalized_legal_description", 0.8, F.col("a"), F.col("a2"))])
    assert {(r.t, r.is_primary) for r in legal.collect()} == {(1, False), (2, False), (3, False)}


@pytest.mark.parametrize("text, code", [("Corrective  Deed", True), ("non-corrective deed", False), ("a correction deed of", True), ("intrafamily", False)])
def test_corrective_deeds(spark, text, code):
    from lotlens.operators import rules

    df = spark.createDataFrame([(1, None, None, text)], "k int, arms boolean, usable boolean, deed string")
    got = {r.exclusion_code for r in rules.sale_exclusions(df, "k", "arms", "usable", ["deed"], ["deed"]).collect()}
    assert ("corrective_deed" in got) == code and ("family_transfer" in got) == (text == "intrafamily")


def test_audit_classes_overlap(spark):
    txns = spark.createDataFrame([(1, "needs_review"), (2, "needs_review"), (3, "needs_review"), (4, "reviewed"), (5, None), (6, "needs_review")], "t int, review_status string")
    matches = spark.createDataFrame([
        (1, "p", "normalized_address", 0.9, 1, False), (1, "q", "normalized_address", 0.9, 2, False), (2, "p", "normalized_legal_description", 0.8, 1, False), (2, "q", "normalized_legal_description", 0.8, 2, False),
        (4, "p", "normalized_legal_description", 0.8, 1, False), (6, "p", "exact_parcel_number", 1.0, 1, True),
    ], "t int, p string, method string, confidence double, match_rank int, is_primary boolean")
    got = {(r.section, r.name): (r.n, r.sample_ids) for r in match.audit(txns, matches, "t", sample=1).collect()}
    assert got == {
        ("totals", "matched"): (4, None), ("totals", "unmatched"): (2, None), ("review_status", "needs_review"): (4, None), ("review_status", "reviewed"): (1, None), ("method", "normalized_address"): (1, None),
        ("method", "normalized_legal_description"): (2, None), ("method", "exact_parcel_number"): (1, None), ("tier", "medium"): (1, None), ("tier", "low"): (2, None), ("tier", "high"): (1, None),
        ("queue", "unresolved"): (1, "3"), ("queue", "ambiguous"): (2, "1"), ("queue", "low_confidence"): (1, "2"),
    }


def test_candidates_have_a_primary_match(spark):
    from lotlens.operators import ratio

    sales = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "txn int, price double")
    matches = spark.createDataFrame([(1, "p", True), (1, "q", False), (2, "q", True), (3, "r", None)], "txn int, parcel_id string, is_primary boolean")
    exclusions = spark.createDataFrame([(2, True), (2, True), (1, False)], "txn int, is_active boolean")
    assert sorted(tuple(r[c] for c in ("txn", "parcel_id", "excluded")) for r in ratio.candidates(sales, matches, exclusions).collect()) == [(1, "p", False), (2, "q", True)]
