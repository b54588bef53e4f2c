from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from lotlens.operators import alerts, facts, features, match, monitor, pick, profile, quality, ratio, review, rules
from lotlens.sources import imports, pages


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_ratio_study_golden(spark):
    """Two ratios 1.0 and 0.5: median .75, COD 33.3333, PRD 1.0; a single one has no COD."""
    sales = spark.createDataFrame(
        [(1, 2025, "McF", "res", 100000.0, 100000.0, False, True), (2, 2025, "McF", "res", 160000.0, 100000.0, True, True), (3, 2025, "McF", "res", 50000.0, 100000.0, False, True),
         (4, 2025, "Mad", "com", 300000.0, 200000.0, False, True), (5, 2025, None, "com", 1.0, 1.0, False, True), (6, 2025, None, None, None, 1.0, False, False)],
        "id int, yr int, muni string, cls string, v double, price double, gone boolean, has_fact boolean",
    )
    lab = ratio.label_sales(sales, ["yr", "muni", "cls"], "v", "price", F.col("gone"))
    assert rows(ratio.outcome_counts(lab), "outcome") == [("blank_group", 1), ("excluded", 1), ("included", 3), ("no_fact", 1)]
    assert rows(ratio.ratio_study(lab, ["yr", "muni", "cls"], "v", "price"), "muni") == [(2025, "Mad", "com", 1, 0, 1.5, None, None, 0, 0), (2025, "McF", "res", 2, 1, 0.75, 33.3333, 1.0, 0, 0)]


def test_mid_rank(spark):
    df = spark.createDataFrame([(1, "a", 0.8), (2, "a", 0.9), (3, "b", 1.0), (4, "a", None)], "id int, g string, r double")
    assert rows(pick.mid_rank_percentile(df, ["g"], "r", "p").select("id", "p"), "id") == [(1, 0.25), (2, 0.75), (3, None), (4, None)]


def test_runs_need_consecutive_years(spark):
    df = spark.createDataFrame([("p", y, "x") for y in (1, 2, 3, 5, 6, 7, 8, 9)], "p string, yr int, s string")
    assert rows(pick.runs_of_years(df, ["p"], "yr", ["s"], 5)) == [("p", "x", 5, 9, 5)]


def test_permit_expected_change(spark):
    cases = [(1, 1, 20000.0, 0, None), (1, 1, 5.0, 1, 5.0), (2, 1, 5.0, 1, 5.0), (0, 0, None, 0, None), (None, None, None, None, None), (0, 1, 5.0, 0, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, n int, dn int, d double, en int, e double")
    dec = lambda c: F.col(c).cast("decimal(14,2)")
    out = df.select("i", features.expected_permit_change(F.col("n"), F.col("dn"), dec("d"), F.col("en"), dec("e")).alias("x")).select("i", "x.*")
    assert rows(out, "i") == [
        (0, 15000.0, "declared", None), (1, None, None, "unresolved_permit_basis"), (2, None, None, "unresolved_permit_basis"), (3, 0.0, "none", "permit_zero_signal_inferred"),
        (4, 0.0, "none", "permit_zero_signal_inferred"), (5, None, None, "missing_permit_context"),
    ]


def test_lineage_reset_three_values(spark):
    r = spark.createDataFrame([("a", 2025, 10), ("b", 2025, 10), ("c", 2025, 10)], "parcel_id string, yr int, v int")
    e = spark.createDataFrame([("a", "p"), ("a", "q"), ("b", "p"), ("b", "none")], "parcel_id string, parent_id string")
    v = spark.createDataFrame([("p", 2024, 60), ("q", 2024, 50)], "parcel_id string, yr int, v int")
    assert rows(features.lineage_reset(r, e, v).select("parcel_id", "reset"), "parcel_id") == [("a", -100.0), ("b", None), ("c", 0.0)]


def test_rules_all_fire_and_none(spark):
    names = ["assessment_to_sale_ratio", "peer_percentile", "yoy_assessment_change_pct", "permit_adjusted_expected_change", "permit_adjusted_gap", "appeal_value_delta_3y", "appeal_success_rate_3y", "lineage_value_reset_delta"]
    df = spark.createDataFrame([("a", 0.5, 0.05, 0.4, None, 60000.0, -20000.0, 0.8, -120000.0), ("b", *[None] * 8)], "id string, " + ", ".join(f"{n} double" for n in names))
    out = rules.score(df)
    assert rows(out.select("id", "raw_score", "score", "band", F.size("triggers"), F.size("skipped")), "id") == [("a", 121.0, 100.0, "high", 6, 0), ("b", 0.0, 0.0, "low", 0, 6)]
    flags = rules.flag_rows(out, ["id"])
    assert [r["weight"] for r in flags.orderBy("reason_rank").collect()] == [35.0, 20.0, 20.0, 18.0, 16.0, 12.0]
    assert rows(rules.primary_reason(flags, ["id"])) == [("a", "ratio__assessment_to_sale_below_floor")]


def test_rescore_keeps_reviewed_ids(spark):
    new = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "k int, score double")
    old = spark.createDataFrame([(1, "s1"), (2, "s2")], "k int, score_id string")
    got = rules.rescore(new, old, spark.createDataFrame([("s1",)], "score_id string"), ["k"])
    assert [(r["k"], r["action"], r["score_id"] == "s1") for r in got.orderBy("k").collect()] == [(1, "update", True), (2, "insert", False), (3, "insert", False)]


def test_corrective_deed_needs_no_hyphen_before(spark):
    df = spark.createDataFrame([(1, "Corrective   Deed", "x", True), (2, "non-corrective deed", "x", True), (3, "", "Town of Oz", None), (4, None, None, False)], "id int, deed string, who string, arms boolean")
    got = rules.sale_exclusions(df.withColumn("usable", F.lit(None).cast("boolean")), "id", "arms", "usable", ["deed"], ["who"])
    assert rows(got, "id") == [(1, "corrective_deed"), (3, "government_transfer"), (4, "non_arms_length")]


def test_cascade_stops_at_first_tier_and_ranks(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, "zz", "x"), (3, "b", "y"), (4, None, None)], "t int, k string, ad string")
    right = spark.createDataFrame([("p1", "a", "x"), ("p2", "q", "x"), ("p3", "b", "n")], "p string, k2 string, ad2 string")
    got = match.cascade(left, right, "t", "p", [("number", 1.0, F.col("k"), F.col("k2")), ("address", 0.9, F.col("ad"), F.col("ad2"))])
    assert rows(got.select("t", "p", "method", "match_rank", "is_primary"), "t", "p") == [(1, "p1", "number", 1, True), (2, "p1", "address", 1, False), (2, "p2", "address", 2, False), (3, "p3", "number", 1, True)]
    unique = match.unique_cascade(left, right, "t", "p", [("address", F.col("ad"), [F.col("ad2")]), ("number", F.col("k"), [F.col("k2")])])
    assert rows(unique, "t") == [(1, "p1", "number"), (3, "p3", "number")]


def test_resolve_parcels_does_not_fall_through_when_ambiguous(spark):
    parcels = spark.createDataFrame([("p1", "n1", "f1"), ("p2", "n1", "f2"), ("p3", "n3", "n9")], "parcel_id string, direct string, formatted string")
    events = spark.createDataFrame([(1, None, "n1"), (2, None, "n3"), (3, None, "n9"), (4, "own", "n3"), (5, None, None)], "i int, parcel_id string, num string")
    assert rows(facts.resolve_parcels(events, parcels, "num").select("i", "resolved"), "i") == [(1, None), (2, "p3"), (3, "p3"), (4, "own"), (5, None)]


def test_small_samples_cap_severity(spark):
    base = spark.createDataFrame([("selector_miss.a", 0, 100), ("selector_miss.b", 0, 20), ("tax_detail_field_presence.c", 0, 0), ("extraction_null_rate.owner", 5, 100), ("gone", 1, 100)], "metric string, num long, den long")
    now = spark.createDataFrame([("selector_miss.a", 5, 100), ("selector_miss.b", 5, 20), ("tax_detail_field_presence.c", 1, 50), ("extraction_null_rate.owner", 60, 100)], "metric string, num long, den long")
    got = monitor.metric_diff(base, now)
    assert rows(got.select("metric", "severity", "reason"), "metric") == [
        ("extraction_null_rate.owner", "error", "error_threshold"), ("gone", "ok", "insufficient_denominator"), ("selector_miss.a", "error", "error_threshold"), ("selector_miss.b", "warn", "warn_threshold"),
        ("tax_detail_field_presence.c", "ok", "insufficient_denominator"),
    ]


def test_review_actions(spark):
    states = spark.createDataFrame([(1, "pending", None), (2, "closed", "confirmed"), (3, "resolved", "confirmed")], "k int, status string, old_disposition string")
    acts = spark.createDataFrame(
        [(1, "resolved", "confirmed", True), (1, "closed", "confirmed", True), (1, "resolved", "confirmed", False), (1, "resolved", None, True), (2, "in_review", None, False), (3, "resolved", None, True), (9, "pending", None, True)],
        "k int, next_status string, disposition string, evidence boolean",
    )
    got = review.validate_actions(acts, states, "k").select("k", "next_status", "error", "outcome", "new_disposition")
    want = {
        (1, "resolved", None, "accepted", "confirmed"), (1, "closed", "invalid_transition", "rejected", None), (1, "resolved", "evidence_link_required", "rejected", None),
        (1, "resolved", "invalid_disposition_for_status", "rejected", None), (2, "in_review", None, "accepted", None), (3, "resolved", None, "no_op", "confirmed"), (9, "pending", "not_found", "rejected", None),
    }
    assert set(rows(got)) == want


def test_alert_routes_and_escalation(spark):
    a = spark.createDataFrame([("e1", "drift", "critical"), ("e2", "other", "info")], "event_id string, alert_type string, severity string")
    routes = spark.createDataFrame([("drift.critical", ["x", "y"]), ("*.*", ["z"])], "route_key string, destinations array<string>")
    sent = spark.createDataFrame([("e1", "x")], "event_id string, destination string")
    assert rows(alerts.fan_out(a, routes, sent), "event_id") == [("e1", "drift.critical", "y"), ("e2", "*.*", "z")]


def test_csv_imports(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "﻿Transfer Date,Recording Date,Consideration,Parcel Number,Property Address\n1/2/2024,,\"$1,000\",06-1,\n2024-13-01,,5,1,\n1/2/2024,bad,5,1,\n1/2/2024,,x,1,\n1/2/2024,,5,,\n,,,,\n1/2/2024,,5,1,a,extra\n"
    )
    got = imports.import_sales(spark, str(tmp_path / "s.csv"))
    assert [r["rejection_reason"] for r in got.orderBy("row_number").collect()] == [None, "transfer_date_unparseable", "recording_date_unparseable", "consideration_unparseable", "no_identifier", "blank_row", "extra_columns"]
    assert got.where("row_number = 1").first()["consideration"] == Decimal("1000.00")
    (tmp_path / "p.csv").write_text("permit_number:,PARCEL #,Issued-Date,Estimated Cost\n1,77,2024-01-02,(5)\n2,n/a,2024-01-02,5\n3,77,soon,5\n4,77\n")
    p = imports.import_permits(spark, str(tmp_path / "p.csv"))
    assert [(r["rejection_reason"], r["import_warnings"]) for r in p.orderBy("row_number").collect()] == [
        (None, []), ("no_locator", []), ("no_temporal_anchor", ["issued_date_unparseable"]), ("no_temporal_anchor", ["missing_columns"]),
    ]
    (tmp_path / "d.csv").write_text("PIN,PIN,Sale Date\n1,2,3\n")
    assert [r["rejection_reason"] for r in imports.import_sales(spark, str(tmp_path / "d.csv")).collect()] == ["duplicate_header"]
    assert imports.upsert(got, got).count() == 7


def test_pages(spark):
    html = (
        "<h2>Tax Summary</h2><table><tr><th>Year</th><th>Amount</th></tr><tr><td>2024<td>$5</tr><tr><td></td><td>$6</td></tr><tr><td></td><td></td></tr></table>"
        "<dl><dt>Owner:</dt><dd>Ann &amp; Bo</dd></dl><h2>Other</h2><table><tr><td>Owner</td><td>Zed</td></tr></table><a href='/061012345678'>Parcel</a><a href='/x'>061/0601-234-5678-9</a>"
    )
    long = pages.extract(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string"))
    assert rows(pages.table_records(long, "tax summary").select("row", "data"), "row") == [(1, {"Year": "2024", "Amount": "$5"}), (2, {"Year": "", "Amount": "$6"})]
    filled = pages.forward_fill(pages.table_records(long, "tax").select("page_id", "row", F.col("data")["Year"].alias("y")), ["page_id"], ["row"], "y")
    assert [r["y"] for r in filled.orderBy("row").collect()] == ["2024", "2024"]
    assert dict(rows(pages.key_values(long).select("name", "value")))["Owner"] == "Zed"
    assert rows(pages.parcel_links(pages.links(long)).select("number", "rank"), "rank") == [("061012345678", 1), ("061/0601-234-5678-9", 2)]
    assert rows(pages.lineage_links(pages.links(long), F.lit("parent"))) == [(1, "061012345678", "parent")]


def test_flag_sync_reads_the_old_flag(spark):
    old = spark.createDataFrame([(1, "a", True), (1, "b", False), (2, "a", True), (2, "b", False)], "id int, code string, is_active boolean")
    new = spark.createDataFrame([(1, "a"), (1, "b"), (3, "a")], "id int, code string")
    got = match.flag_sync(new, old, ["id", "code"]).orderBy("id", "code").collect()
    assert [(r["id"], r["code"], r["is_active"], r["action"]) for r in got] == [
        (1, "a", True, "keep"), (1, "b", True, "reactivate"), (2, "a", False, "deactivate"), (2, "b", False, "none"), (3, "a", True, "insert"),
    ]


def test_burn_with_a_target_of_one(spark):
    names = [f"{c}_{w}" for w in ("1h", "6h", "24h", "w") for c in ("pass", "total")]
    df = spark.createDataFrame([tuple([30, 30] * 4), tuple([29, 30] * 4), tuple([0, 0] * 4)], ", ".join(f"{n} long" for n in names))
    got = [(r["burn_1h"], r["budget_left"]) for r in monitor.burn_rates(df, 1.0).orderBy(F.desc("pass_w")).collect()]
    assert got == [(0.0, 1.0), (1e6, 0.0), (0.0, 1.0)]


def test_tables_without_and_with_repeated_headers(spark):
    html = "<table><tr><td>1</td><td>2</td></tr></table><table><tr><th>A</th><th>A</th></tr><tr><td>x</td><td>y</td></tr></table>"
    long = pages.extract(spark.createDataFrame([(1, html)], "page_id long, html string"))
    assert [r["data"] for r in pages.table_records(long).orderBy("record").collect()] == [{"col_1": "1", "col_2": "2"}, {"A": "y"}]


def test_blank_lines_and_long_fields(spark, tmp_path):
    (tmp_path / "l.csv").write_text("Sale Date,PIN,Note\n\n01/02/2020,7," + "x" * 200_000 + "\n\n01/03/2020,8,y\n")
    got = imports.csv_rows(spark, str(tmp_path / "l.csv")).orderBy("row_number").collect()
    assert [(r["row_number"], len(r["cells"]["Note"])) for r in got] == [(1, 200_000), (2, 1)]


def test_context_years_and_dossier_match(spark):
    facts_ = spark.createDataFrame([(1, y, float(y)) for y in range(2000, 2008)], "parcel_id int, yr int, v double")
    sales = spark.createDataFrame([(1, 1, 2001), (2, 1, 1990), (3, 9, 2001), (4, 1, None)], "txn int, parcel_id int, yr int")
    got = rows(match.context_years(sales, facts_).select("txn", "fact_yr"), "txn", "fact_yr")
    assert got == [(1, y) for y in range(2000, 2004)] + [(2, y) for y in range(2003, 2008)]
    m = spark.createDataFrame(
        [("a", 1, None, 0.9, 1), ("a", 2, True, None, None), ("b", 3, False, None, 1), ("b", 4, False, 0.1, None), ("c", 6, False, 0.5, None), ("c", 5, False, 0.5, None), ("c", 7, None, 0.5, 9)],
        "txn string, id int, is_primary boolean, confidence double, match_rank int",
    )
    assert rows(match.dossier_match(m, "txn", "id").select("txn", "id"), "txn") == [("a", 2), ("b", 4), ("c", 7)]


def test_profile_of_empty_tables(spark):
    fetches = spark.createDataFrame([], "fetch_id long, parcel_id long, status_code int, parsed_at date, parse_error string")
    named = profile.counts(fetches, fetches, {"fact": fetches}, {"tax": fetches})
    out = profile.snapshot(profile.coverage(named, ["fact"], ["tax"]), profile.field_presence(fetches, ["parse_error"]))
    found = rows(out, "metric")
    names = ["coverage.parse_error_successful_fetch_rate", "coverage.parsed_successful_fetch_rate", "extraction_null_rate.parse_error", "selector_miss.tax_fetch_rate", "tax_detail_field_presence.parse_error.rate"]
    assert found == [(name, 0, 0, None) for name in names]


def test_payment_semantics(spark):
    signals = spark.createDataFrame([(1, True, True), (2, False, True)], "fetch_id int, has_real boolean, has_placeholder boolean")
    flags = spark.createDataFrame([("a", 1, True), ("b", 2, None), ("c", 3, None)], "key string, fetch_id int, available boolean")
    facts_ = spark.createDataFrame([("f", 2, True, 0, None), ("g", 2, True, 1, None), ("h", 9, True, None, 5.0), ("i", None, None, 3, 5.0), ("j", 1, None, None, None)], "key string, fetch_id int, placeholder boolean, event_count int, total double")
    facts_ = facts_.withColumns({"first_date": F.lit(None).cast("date"), "last_date": F.lit(None).cast("date")})
    got = rows(quality.payment_semantics(signals, flags, facts_).select("key", "code"), "key", "code")
    assert got == [("b", "payment_history_flag_mismatch"), ("g", "placeholder_payment_rollup_conflict"), ("h", "placeholder_payment_rollup_conflict"), ("j", "payment_placeholder_flag_mismatch")]
