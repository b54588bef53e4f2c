"""The wide fact: winners, roll-ups and years of small hand-made parcels."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from lotlens.operators import wide

D = Decimal
AT = datetime.datetime(2024, 1, 1)
_A = ", ".join(f"{f} {'string' if f == 'valuation_classification' else 'date' if f == 'valuation_date' else 'decimal(14,2)'}" for f in wide.ASSESSMENT_FIELDS)
_T = ", ".join(f"{f} decimal(14,2)" for f in wide.TAX_FIELDS)
SCHEMAS = {
    "summaries": "parcel_id string, fetch_id long, fetched_at timestamp, " + ", ".join(f"{f} string" for f in wide.SUMMARY_FIELDS),
    "assessments": f"parcel_id string, year int, id long, fetch_id long, fetched_at timestamp, source string, {_A}",
    "taxes": f"parcel_id string, year int, id long, fetch_id long, fetched_at timestamp, source string, {_T}",
    "payments": "parcel_id string, year int, fetch_id long, fetched_at timestamp, source string, date date, amount decimal(14,2), placeholder boolean",
    "permits": "parcel_id string, year int, status string, declared decimal(14,2), estimated decimal(14,2)",
    "appeals": "parcel_id string, year int, outcome string, change decimal(14,2)",
}


@pytest.fixture()
def facts(spark):
    def of(**rows):
        made = wide.parcel_year_facts(**{k: spark.createDataFrame(rows.get(k, []), s) for k, s in SCHEMAS.items()})
        return {(r.parcel_id, r.year): r for r in made.collect()}

    return of


def assessment(year, id, fetch, at, source, total, **more):
    known = dict.fromkeys(wide.ASSESSMENT_FIELDS) | {"total_value": total} | more
    return ("P", year, id, fetch, at, source, *known.values())


def test_recent_permits_and_appeal_outcomes(facts):
    got = facts(
        permits=[("P", 2023, "issued", D(10), D(20))],
        appeals=[("P", 2024, "reduction_granted", D(-100)), ("P", 2024, "partial_reduction", D(50)), ("P", 2024, None, None), ("P", 2025, "denied", D(20))],
    )
    assert sorted(got) == [("P", 2023), ("P", 2024), ("P", 2025)]
    a, b = got["P", 2024], got["P", 2025]
    assert (a.permit_event_count, a.permit_recent_1y_count, a.permit_has_recent_1y, a.permit_recent_2y_count, a.permit_has_recent_2y) == (None, 1, True, 1, True)
    assert (a.appeal_event_count, a.appeal_reduction_granted_count, a.appeal_partial_reduction_count, a.appeal_unknown_outcome_count) == (3, 1, 1, 1)
    assert [a[f"appeal_{o}_count"] for o in ("denied", "withdrawn", "dismissed", "pending")] == [0, 0, 0, 0]
    assert (a.appeal_value_change_known_count, a.appeal_value_change_total, a.appeal_value_change_reduction_total, a.appeal_value_change_increase_total) == (2, D(-50), D(-100), D(50))
    assert (b.appeal_event_count, b.appeal_value_change_total, b.appeal_value_change_reduction_total, b.appeal_value_change_increase_total) == (1, D(20), D(0), D(20))
    assert (b.permit_recent_1y_count, b.permit_has_recent_1y, b.permit_recent_2y_count) == (None, None, 1)
    first = got["P", 2023]
    assert (first.permit_event_count, first.permit_status_issued_count, first.permit_status_unknown_count, first.permit_declared_valuation_sum) == (1, 1, 0, D(10))


def test_best_assessment_and_tax(facts):
    none = [None] * 8
    got = facts(
        assessments=[
            assessment(2024, 1, 1, AT, "summary", D(1), land_value=D(1), improved_value=D(1)), assessment(2024, 2, 2, None, "detail", D(2)), assessment(2024, 3, 9, AT, "valuation_breakout", D(3), land_value=D(3)),
            assessment(2023, 4, 1, None, "detail", D(4)), assessment(2023, 5, 2, AT, "detail", D(5)), assessment(2023, 6, 2, AT, "detail", D(6)), assessment(None, 7, 3, AT, "detail", D(7)), assessment(2020, 8, 3, AT, "valuation_breakout", D(8)),
        ],
        taxes=[("P", 2024, 1, 1, AT, "detail", *[D(1)] * 8), ("P", 2024, 2, 2, AT, "summary", D(2), *none[1:]), ("P", 2024, 3, 1, None, "summary", D(3), D(3), *none[2:])],
        summaries=[("P", 1, None, "old", None, None, None, None), ("P", 2, AT, "new", "text", None, None, None), ("Q", 5, AT, "q", None, None, None, None)],
    )
    assert sorted(got) == [("P", 2020), ("P", 2023), ("P", 2024)]
    a = got["P", 2024]
    assert (a.assessment_fetch_id, a.assessment_total_value, a.tax_fetch_id, a.tax_assessed_land_value) == (2, D(2), 1, D(3))
    assert (got["P", 2023].assessment_total_value, got["P", 2020].assessment_total_value, got["P", 2020].tax_fetch_id) == (D(6), None, None)
    assert {(r.parcel_summary_fetch_id, r.municipality_name, r.current_parcel_description) for r in got.values()} == {(2, "new", "text")}


def test_payments_of_the_best_fetch(facts):
    day = datetime.date(2024, 2, 1)
    rows = [
        ("P", 2024, 1, AT, "summary", day, D(10), False), ("P", 2024, 1, AT, "summary", day.replace(day=9), D(5), False), ("P", 2024, 1, AT, "summary", None, D(99), True),
        ("P", 2024, 2, AT.replace(year=2025), "summary", day, D(10), False), ("P", 2024, 3, AT, "tax_detail_payments", day, D(1), False), ("P", 2024, 3, AT, "tax_detail_payments", day, D(1), False), ("P", 2024, 3, AT, "tax_detail_payments", day, D(1), False),
        ("P", 2023, 4, AT, None, None, None, True), ("P", 2022, 5, AT, "summary", None, D(3), False), ("P", 2021, 6, AT, "tax_detail_payments", day, D(1), False),
    ]
    got = facts(payments=rows)
    cols = ["payment_fetch_id", "payment_event_count", "payment_total_amount", "payment_first_date", "payment_last_date", "payment_has_placeholder_row"]
    assert [got["P", 2024][c] for c in cols] == [1, 2, D(15), day, day.replace(day=9), True]
    assert [got["P", 2023][c] for c in cols] == [4, 0, None, None, None, True]
    assert [got["P", 2022][c] for c in cols] == [None] * 6 and [got["P", 2021][c] for c in cols] == [None] * 6


def test_no_rows_no_facts(facts):
    assert facts() == {}
