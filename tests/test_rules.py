"""Explanations and evidence of flags, and the validation of feature rows."""

from __future__ import annotations

import pytest
from lotlens.operators import features, rules
from pyspark.sql import functions as F

FEATURES = "id int, assessment_to_sale_ratio double, peer_percentile double, permit_adjusted_gap double, yoy_assessment_change_pct double, permit_adjusted_expected_change double, appeal_success_rate_3y double, appeal_value_delta_3y double, lineage_value_reset_delta double, basis string"


def test_each_rule_explains_itself(spark):
    rows = [(1, 0.5, 0.05, 60000.0, 0.4, None, 0.8, -20000.0, -150000.0, "unknown"), (2, 0.6, 0.1, 20000.0, 0.2, 10000.0, 0.75, -5000.0, -50000.0, "declared"), (3, None, None, None, 0.5, 10001.0, 0.9, -1.0, None, None)]
    flags = rules.flag_rows(rules.score(spark.createDataFrame(rows, FEATURES)), ["id"], permit_basis="basis")
    got = {(r.id, r.rule): (r.explanation, r.evidence) for r in flags.collect()}
    assert {k for k in got if k[0] == 3} == set() and len(got) == 12
    assert got[1, "ratio"] == ("Assessment-to-sale ratio 0.500000 is below threshold 0.55.", None)
    assert got[2, "ratio"][0] == "Assessment-to-sale ratio 0.600000 is below threshold 0.70."
    assert got[1, "peer"][0] == "Peer percentile 0.0500 is at or below threshold 0.05 for the parcel peer group."
    assert got[2, "permit_gap"][0] == "Permit-adjusted gap 20000.00 exceeds threshold 20000, indicating unexplained assessed-value increase."
    assert got[1, "yoy"] == (
        "Year-over-year assessment change 0.400000 exceeds threshold 0.35 without strong permit support (is_null vs cutoff 10000).",
        {"permit_adjusted_expected_change": None, "permit_adjusted_expected_change_condition": "is_null", "permit_adjusted_expected_change_cutoff": "10000", "permit_basis": "unknown"},
    )
    assert got[2, "yoy"][1] == {"permit_adjusted_expected_change": "10000.00", "permit_adjusted_expected_change_condition": "<=_cutoff", "permit_adjusted_expected_change_cutoff": "10000", "permit_basis": "declared"}
    assert got[1, "appeals"] == ("Appeal success rate 0.8000 meets threshold 0.75 with net negative appeal value change over 3 years.", {"appeal_value_delta_3y": "-20000.00", "appeal_value_delta_threshold": "-15000"})
    assert got[2, "appeals"][1] == {"appeal_value_delta_3y": "-5000.00", "appeal_value_delta_threshold": "-5000"} and "threshold 0.60" in got[2, "appeals"][0]
    assert got[2, "lineage"][0] == "Lineage reset delta -50000.00 is at or below threshold -50000, indicating a post-lineage value drop."


ROW = {
    "parcel_id": "p", "year": 2024, "feature_version": "v1", "assessment_to_sale_ratio": 0.9, "peer_percentile": 0.5, "permit_adjusted_expected_change": 5.0, "permit_basis": "declared", "permit_source_keys": [("p", 2023), ("p", 2024)],
    "appeal_value_delta_3y": -1.0, "appeal_success_rate_3y": 0.5, "appeal_source_keys": [("p", 2024)], "appeal_value_detail_status": "known", "appeal_outcome_detail_status": "known", "related_parcel_ids": ["a", "b"], "relationship_count": 2,
    "source_ref_keys": features.SOURCE_REFS, "quality_flags": ["f", "g"],
}
_KEYS = "array<struct<parcel_id: string, year: int>>"
SCHEMA = (
    "parcel_id string, year int, feature_version string, assessment_to_sale_ratio double, peer_percentile double, permit_adjusted_expected_change double, permit_basis string, "
    f"permit_source_keys {_KEYS}, appeal_value_delta_3y double, appeal_success_rate_3y double, appeal_source_keys {_KEYS}, appeal_value_detail_status string, appeal_outcome_detail_status string, related_parcel_ids array<string>, relationship_count int, "
    "source_ref_keys array<string>, quality_flags array<string>"
)
CASES = [
    ({}, []), ({"parcel_id": " "}, ["missing_required_parcel_id"]), ({"year": 0}, ["invalid_year"]), ({"feature_version": ""}, ["missing_required_feature_version"]), ({"assessment_to_sale_ratio": -0.1}, ["negative_assessment_to_sale_ratio"]),
    ({"peer_percentile": 1.1, "assessment_to_sale_ratio": None}, ["out_of_bounds_peer_percentile", "peer_percentile_without_ratio"]), ({"appeal_success_rate_3y": -0.5}, ["out_of_bounds_appeal_success_rate_3y"]),
    ({"permit_basis": "none"}, ["permit_basis_none_with_nonzero_expected_change", "permit_basis_none_with_source_keys"]), ({"permit_basis": "none", "permit_adjusted_expected_change": 0.0, "permit_source_keys": []}, []),
    ({"permit_basis": "none", "permit_adjusted_expected_change": None, "permit_source_keys": None}, ["permit_basis_none_with_nonzero_expected_change"]), ({"permit_basis": "unknown"}, ["permit_basis_unknown_with_expected_change"]),
    ({"permit_basis": "estimated", "permit_adjusted_expected_change": None, "permit_source_keys": []}, ["permit_basis_known_without_expected_change", "permit_basis_known_without_source_keys"]), ({"permit_basis": "other"}, ["invalid_permit_basis"]), ({"permit_basis": None}, ["invalid_permit_basis"]),
    ({"permit_source_keys": [("p", 2024), ("p", 2023)]}, ["permit_source_keys_not_sorted_unique"]), ({"appeal_source_keys": [("p", 2024), ("p", 2024)]}, ["appeal_source_keys_not_sorted_unique"]),
    ({"appeal_value_detail_status": "x", "appeal_outcome_detail_status": None}, ["invalid_appeal_outcome_detail_status", "invalid_appeal_value_detail_status"]), ({"appeal_value_detail_status": "none"}, ["appeal_value_none_with_source_keys", "appeal_value_none_with_value"]),
    ({"appeal_value_delta_3y": None, "appeal_source_keys": []}, ["appeal_outcome_known_without_source_keys", "appeal_value_known_without_source_keys", "appeal_value_known_without_value"]),
    ({"appeal_value_detail_status": "missing", "appeal_outcome_detail_status": "missing", "appeal_source_keys": None}, ["appeal_outcome_missing_with_rate", "appeal_outcome_missing_without_source_keys", "appeal_value_missing_with_value", "appeal_value_missing_without_source_keys"]),
    ({"appeal_outcome_detail_status": "none"}, ["appeal_outcome_none_with_rate", "appeal_outcome_none_with_source_keys"]), ({"related_parcel_ids": ["b", "a"]}, ["lineage_related_parcels_not_sorted_unique"]),
    ({"source_ref_keys": ["sales"]}, ["missing_required_source_refs_keys", "missing_source_refs_lineage"]), ({"relationship_count": None}, ["lineage_relationship_count_mismatch"]), ({"related_parcel_ids": None, "relationship_count": 0}, []),
]


@pytest.fixture(scope="module")
def checked(spark):
    rows = [tuple({**ROW, **change, "feature_version": change.get("feature_version", f"v{k}")}.values()) for k, (change, _) in enumerate(CASES)]
    return features.validated(spark.createDataFrame(rows, SCHEMA)).cache()


def test_every_error_code(checked):
    got = {r.feature_version: r.errors for r in checked.collect()}
    assert [got[c.get("feature_version", f"v{k}")] for k, (c, _) in enumerate(CASES)] == [want for _, want in CASES]
    assert len({e for _, want in CASES for e in want}) == 32


def test_counts_of_a_build(checked):
    got = {(r.kind, r.name): r.n for r in features.build_diagnostics(checked).collect()}
    assert got["rows", "inserted"] == 3 and got["rows", "skipped"] == len(CASES) - 3 and got["rows", "with_quality_flags"] == 3 and got["rows", "quality_warnings"] == 6
    assert (got["flag", "f"], got["flag", "g"]) == (3, 3) and got["error", "invalid_permit_basis"] == 2
    assert features.skipped_sample(checked, 4).count() == 4 and features.skipped_sample(checked.where(F.size("errors") == 0)).count() == 0
