"""What of lines travels to their part, and what the windows over part-years sort."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lotlens.operators import pick
from lotlens.plans import scoring, valuation

SF = "/root/testdata/sf0.001"


def test_lines_travel_as_four_columns_and_windows_sort_no_structs(spark, monkeypatch):
    written = []
    monkeypatch.setattr(scoring, "cut", lambda df, *more: written.append(df) or df)
    scoring.feature_rows(spark, SF)
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    nodes = plan.splitlines()
    dealt = next(i for i, x in enumerate(nodes) if "REPARTITION_BY_COL" in x)
    sent = re.search(r"Project \[(.*)\]$", nodes[dealt + 1]).group(1)
    assert [re.sub(r"#\d+L?$", "", x.split(" AS ")[-1]) for x in re.split(r", (?=[^()]*(?:\(|$))", sent) if " AS " in x or x.startswith("l_")][-1] == "m"
    assert "AS status" not in sent and "AS declared" not in sent and "AS change" not in sent
    windows = [x for x in nodes if " Window [" in x]
    assert windows and all("permit" not in x and "appeal." not in x for x in windows)


def test_dealt_lines_say_what_events_say(spark):
    price = F.col("l_extendedprice").cast("decimal(14,2)").alias("cents")
    full, sent = valuation.events(spark, SF, price), valuation.dealt_events(spark, SF)
    plain = full.select("parcel_id", "yr", "cents", F.when(F.col("status").isin("A", "N"), F.col("status")).when(F.col("status").isNotNull(), "?").alias("status"), "declared", "estimated",
                        F.when(F.col("outcome") == "F", "F").when(F.col("outcome").isNotNull(), "?").alias("outcome"), "change")
    assert sent.columns == plain.columns and sent.dtypes == plain.dtypes
    assert sent.exceptAll(plain).count() == 0 and plain.exceptAll(sent).count() == 0


def test_largest_row_with_values_beside_its_order(spark):
    df = spark.createDataFrame([(1, 5, None, [1]), (1, 5, 2, [2]), (1, None, 9, [3]), (2, None, 7, [4])], "k int, a int, b int, c array<int>")
    assert sorted(tuple(r) for r in pick.largest_row(df, ["k"], ["a", "b"], ["b"]).collect()) == [(1, 2), (2, 7)]
    assert sorted((r.k, r.c) for r in pick.largest_row(df, ["k"], ["a", "b"], ["c", "a"]).collect()) == [(1, [2]), (2, [4])]
