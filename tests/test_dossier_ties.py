from __future__ import annotations

from pyspark.sql import functions as F

from lotlens.operators import dossier
from lotlens.plans import dossiers
from lotlens.plans import valuation as v

SF = "/root/testdata/sf0.001"


def test_rows_with_one_id_have_one_order(spark, monkeypatch):
    features = spark.createDataFrame([], "parcel_id long, yr int, assessment_to_sale_ratio double, peer_percentile double, yoy_assessment_change_pct double, permit_adjusted_expected_change double, permit_adjusted_gap double, appeal_value_delta_3y double, appeal_success_rate_3y double, lineage_value_reset_delta double")
    monkeypatch.setattr(dossiers.scoring, "feature_rows", lambda *_: features)
    sources = v.fact_sources(spark, SF)
    facts = spark.createDataFrame([], "parcel_id long, year int, assessment_total_value decimal(14,2), assessment_valuation_date date")
    order = dossiers._sections(spark, SF, facts, sources)["assessments"][1]
    a, b = "(1L, 7L, 1999, 41008.97BD, date'1999-07-04')", "(1L, 7L, 1999, null, date'1999-01-23')"
    said = []
    for rows in (f"{a}, {b}", f"{b}, {a}"):
        own = spark.sql(f"select * from values {rows} as t(parcel_id, assessment_id, year, total_value, valuation_date)").coalesce(1)
        got = dossier.documents(spark.range(1, 2).select(F.col("id").alias("parcel_id")), {"assessments": (own, order)}, 5).first()
        said.append([str(r["valuation_date"]) for r in got["assessments"]])
    assert said == [["1999-07-04", "1999-01-23"]] * 2
