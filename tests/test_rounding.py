"""Values and texts of metrics at ties, held against DuckDB's rounding."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from lotlens.operators import features, rules


def test_ties_of_ratios_and_their_texts_are_those_of_sql(spark):
    pairs = [((2 * k + 1) * price / 2e6, price) for price in (32000.0, 160000.0, 144000.0) for k in range(1, 20000) if (2 * k + 1) * price % 20000 == 0]
    df = spark.createDataFrame(pairs, "v double, p double").repartition(4)
    ratio = features.assessment_ratio(F.col("v"), F.col("p"))[0]
    change = features.change_pct(F.col("v"), F.col("p"))
    got = df.select("v", "p", ratio.alias("ratio"), change.alias("change"), rules.metric_text("assessment_to_sale_ratio", F.col("v") / F.col("p")).alias("text"), rules.metric_text("peer_percentile", F.col("v") / F.col("p")).alias("short")).toPandas()
    con = duckdb.connect()
    con.register("got", got)
    wrong = con.execute("""select v, p from got where ratio <> round(v / p, 6) or change <> round((v - p) / p, 6)
      or text <> cast(cast(v / p as decimal(20,6)) as varchar) or short <> cast(cast(v / p as decimal(20,4)) as varchar)""").fetchall()
    assert len(got) == len(pairs) and wrong == []
