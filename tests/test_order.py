"""Order statistics and as-of look-ups against plain Python."""

from __future__ import annotations

import bisect
import datetime
import math
import random
import statistics
from collections import defaultdict

import pytest
from lotlens.operators import order, ratio
from lotlens.operators.order import MEDIAN, nearest_rank
from pyspark.sql import functions as F


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_order_statistics_equal_plain(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(3000):
        group = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "lone", ""])
        kind = rng.random()
        value = None if kind < 0.1 else 0.0 if kind < 0.15 else rng.choice([1.0, 1.005, 1.02]) if kind < 0.4 else rng.gauss(0, 10 ** rng.randint(-4, 6))
        rows.append((group, value, k % 7))
    rows = [r for r in rows if r[0] != "lone"] + [("lone", None, 1), ("lone", None, 2), ("one", -3.5, 1)]
    df = spark.createDataFrame(rows, "g string, v double, w int").repartition(4)
    got = order.order_statistics(df, ["g"], "v", {"m": MEDIAN, "p10": nearest_rank(0.1), "p95": nearest_rank(0.95), "all": nearest_rank(1.0)}, {"w": F.col("w"), "rows": F.lit(1)}, spread="m")
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    found = {r.g: r for r in got.collect()}
    assert set(found) == set(by)
    for g, own in by.items():
        values = sorted(v for _, v, _ in own if v is not None)
        r, n = found[g], len(values)
        assert (r.n, r.w, r.rows) == (n, sum(w for *_, w in own), len(own))
        if not n:
            assert r.m is None and r.p95 is None and r.total is None
            continue
        m = statistics.median(values)
        assert r.m == pytest.approx(m) and r.total == pytest.approx(sum(values)) and r.deviation == pytest.approx(sum(abs(v - m) for v in values))
        for p, x in ((0.1, r.p10), (0.95, r.p95), (1.0, r.all)):
            assert x == values[max(1, math.ceil(p * n)) - 1]
    assert order.order_statistics(df.where("false"), ["g"], "v", {"m": MEDIAN}).count() == 0


def test_buckets_follow_values(spark):
    rng = random.Random(4)
    values = sorted([rng.gauss(0, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(2000)] + [0.0, 1.0, -1.0, math.inf, -math.inf, 5e-324])
    got = [r.b for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").select("k", order.bucket_of(F.col("v")).alias("b")).orderBy("k").collect()]
    assert got == sorted(got)


def test_study_of_four_sales(spark):
    """Medians, COD and PRD of a group of two, one excluded sale and a group that is too small."""
    rows = [(2025, "McFarland", "residential", 50.0, 100.0, False), (2025, "McFarland", "residential", 200.0, 200.0, False), (2025, "McFarland", "residential", 10.0, 100.0, True), (2025, "Madison", "commercial", 150.0, 100.0, False)]
    df = spark.createDataFrame(rows, "yr int, muni string, cls string, v double, price double, ex boolean").withColumn("has_fact", F.lit(True))
    got = {r.muni: r for r in ratio.ratio_study(ratio.label_sales(df, ["yr", "muni", "cls"], "v", "price", F.col("ex")), ["yr", "muni", "cls"], "v", "price").collect()}
    a, b = got["McFarland"], got["Madison"]
    assert (a.n, a.n_excluded, a.median_ratio, a.cod, a.n_low, a.n_high) == (2, 1, 0.75, 33.3333, 0, 0) and a.prd == pytest.approx(0.75 / (250 / 300), abs=1e-4)
    assert (b.n, b.median_ratio, b.cod, b.prd) == (1, 1.5, None, None)


def test_out_of_scope_sales_are_their_own_outcome(spark):
    rows = [(2025, "m", "c", 1.0, 1.0, True), (2025, "m", "c", 1.0, 1.0, False), (2025, "m", " ", 1.0, 1.0, False)]
    df = spark.createDataFrame(rows, "yr int, muni string, cls string, v double, price double, inside boolean").withColumn("has_fact", F.lit(True))
    got = ratio.outcome_counts(ratio.label_sales(df, ["yr", "muni", "cls"], "v", "price", F.lit(False), F.col("inside")))
    assert {r.outcome: r.n for r in got.collect()} == {"included": 1, "out_of_scope": 1, "blank_group": 1}


@pytest.mark.parametrize("unit", ["hour", "day"])
def test_as_of_equals_plain(spark, unit):
    rng = random.Random(9)
    start = datetime.datetime(2024, 1, 1)
    moment = lambda: start + datetime.timedelta(seconds=rng.randrange(5 * 86400 // 300) * 300)  # noqa: E731  many ties
    events = [(rng.choice(["hot", "hot", "hot", "b", None]), moment() if rng.random() < 0.97 else None) for _ in range(1500)]
    checks = [(rng.choice(["hot", "b", None, "never"]), moment() - datetime.timedelta(days=rng.choice([0, 0, 3])), k) for k in range(400)] + [("hot", None, 400)]
    found = order.as_of(spark.createDataFrame(checks, "p string, at timestamp, id int"), spark.createDataFrame(events, "p string, at timestamp"), ["p"], "at", unit=unit)
    times = defaultdict(list)
    for p, at in events:
        if at is not None:
            times[p].append(at)
    want = {}
    for p, at, k in checks:
        own = sorted(times[p])
        want[k] = own[bisect.bisect_right(own, at) - 1] if at is not None and own and own[0] <= at else None
    got = {r.id: r.last_at for r in found.collect()}
    assert got == want
