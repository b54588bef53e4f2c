"""Queries on data quality, profiles, drift, load, service levels and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.operators import alerts, monitor, order, pick, quality
from lotlens.operators.order import nearest_rank, order_statistics
from lotlens.plans import parcels
from lotlens.runtime import scratch, table
from lotlens.sources import sinks

#: What the clock reads in these queries; the events end before it.
NOW = "2024-01-31 00:00:00"


def _now() -> Column:
    return F.to_timestamp(F.lit(NOW))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as runs: profile, at, seconds, ok, k (a number in their settings)."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id", (F.col("user_id") % 3).alias("profile"), F.col("ts").alias("at"), F.round("value", 2).alias("seconds"), (F.col("event_type") != "error").alias("ok"),
        F.get_json_object("props", "$.k").cast("long").alias("k"), "event_type", "user_id",
    )


_RUNS = """runs as (
  select event_id, user_id % 3 as profile, ts as at_, round(value, 2) as seconds, event_type <> 'error' as ok, cast(json_extract_string(props, '$.k') as bigint) as k, event_type, user_id
  from events)"""


def _assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as assessments of their parts: values that stay for years, dates of the eighties, and some that are odd."""
    l = table(spark, sf_dir, "lineitem").where("l_linenumber <= 3")  # noqa: E741
    cents, odd = F.col("l_extendedprice").cast("decimal(14,2)"), F.col("l_quantity")
    year = F.year("l_shipdate")
    day = F.when(odd == 49, F.make_date(year + 10, F.lit(1), F.lit(2))).when(odd == 2, F.make_date(year + 1, F.lit(6), F.lit(1))).when(odd != 3, F.make_date(F.lit(1982) + F.pmod("l_partkey", F.lit(9)), F.lit(1), F.lit(1)))
    base = F.col("l_partkey").cast("decimal(14,2)")
    return l.select(
        F.concat_ws("|", "l_orderkey", "l_linenumber").alias("id"), F.col("l_partkey").alias("parcel_id"), F.when(odd != 7, year).alias("year"), day.alias("valuation_date"),
        F.when(F.pmod("l_partkey", F.lit(3)) > 0, "R").alias("valuation_classification"), F.when(odd == 11, -base).otherwise(base).alias("assessment_acres"),
        F.when(odd != 12, base + 10).alias("land_value"), F.when(odd > 45, cents - 30000).otherwise(base).cast("decimal(14,2)").alias("improved_value"), F.when(odd == 13, -base).otherwise(base * 2 + 10).cast("decimal(14,2)").alias("total_value"),
    )


def _lineitem_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, line = _assessments(spark, sf_dir), table(spark, sf_dir, "lineitem")
    dates = quality.suspicious_dates(own, F.col("id"), F.lit("2001-01-01").cast("date"))
    numbers = quality.impossible_assessments(own, F.col("id"))
    key = F.concat_ws("|", "l_orderkey", "l_linenumber")
    taxes = quality.negative_amounts(line.where("l_linenumber = 4"), key, F.col("l_tax") < 0.01, "tax")
    payments = quality.negative_amounts(line.where("l_linenumber = 5"), key, F.col("l_discount") < 0.01, "payment")
    twice = quality.duplicate_summaries(line.where("l_quantity = 50").select(F.col("l_partkey").alias("parcel_id")))
    return quality.report(dates, numbers, taxes, payments, twice)


def quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_issues(spark, sf_dir).groupBy("check", "key", "code").agg(F.count("*").alias("n"))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = spark.createDataFrame([(quality.DATES,), (quality.NUMBERS,), (quality.DUPLICATES[0],), (quality.LINEAGE,)], "check string")
    return quality.summary(_lineitem_issues(spark, sf_dir), checks)


def lineage_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as links from customers to parts of their lines; priorities are link types."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    edges = line.join(orders, "l_orderkey").select(F.col("o_custkey").cast("string").alias("a"), F.col("l_partkey").cast("string").alias("b"), F.col("o_orderpriority").alias("kind"))
    return quality.lineage_consistency(edges, "a", "b", "kind", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]).groupBy("check", "key", "code").agg(F.count("*").alias("n"))


def fetch_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as fetches with lines as parsed rows: four codes from status, total and child counts."""
    children = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("rows"))
    rows = table(spark, sf_dir, "orders").join(children, "o_orderkey", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    ok, parsed = F.col("o_orderstatus") != "P", F.col("o_totalprice") > 100000
    codes = {"success_not_parsed": ok & ~parsed & (F.col("rows") > 5), "failed_but_parsed": ~ok & parsed, "parsed_without_rows": parsed & (F.col("rows") == 0), "rows_without_parse": ~parsed & (F.col("rows") > 6)}
    return quality.issues(rows, "fetch_parse", F.col("o_orderkey"), codes)


def payment_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null-safe compares of what an order says with what its lines say."""
    sums = table(spark, sf_dir, "lineitem").where("l_discount > 0.02").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_linestatus").alias("s"), F.max("l_shipdate").alias("last"))
    rows = table(spark, sf_dir, "orders").join(sums, "o_orderkey", "left")
    own = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    codes = {"status_mismatch": ~own.eqNullSafe(F.col("s")), "missing_rows": F.col("last").isNull(), "date_before_order": F.col("last") < F.col("o_orderdate")}
    return quality.issues(rows, "payment_semantics", F.col("o_orderkey"), codes)


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_orderstatus", "o_totalprice")
    part = lambda status, less: orders.where(F.col("o_orderstatus") == status).select("id", (F.col("o_totalprice") - less).alias("amount"))
    return quality.presence_anomalies(ids, "id", assessment=part("F", 5000), tax=part("O", 2000), payment=part("P", 1500))


def data_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and coverage of documents and labels: distinct sources, rows of one table that the other lacks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("has", F.lit(True))
    rows = docs.join(labelled, "doc_id", "left")
    n = F.count("*")
    return rows.groupBy("lang").agg(
        n.alias("n"), F.countDistinct("source").alias("n_sources"), F.count("has").alias("n_labelled"), (n - F.count("has")).alias("n_gap"), F.round(F.count("has") / n, 4).alias("coverage"),
        F.round(F.count_if(F.col("n_chars") > 500) / n, 4).alias("long_rate"),
    )


def section_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label, and labels without a document (set differences)."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    one = docs.join(labels, "doc_id", "left_anti").select(F.lit("no_label").alias("gap"), "doc_id")
    return one.unionByName(labels.join(docs, "doc_id", "left_anti").select(F.lit("no_document").alias("gap"), "doc_id"))


def drift_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later of the two snapshots that drift_diff compares."""
    return parcels.half_snapshot(spark, sf_dir, True)


def drift_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the late fetches against that of the early ones."""
    return monitor.metric_diff(parcels.half_snapshot(spark, sf_dir, False), parcels.half_snapshot(spark, sf_dir, True))


def drift_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drift_diff(spark, sf_dir).withColumn("family", F.substring_index("metric", ".", 1))
    return monitor.alerts_of(rows, ["family"], {"ok": 0, "warn": 1, "error": 2})


def _benchmark(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    """Metrics of the first or the second half of the events as a review queue: large and small segments, few confirmed cases."""
    half = _runs(spark, sf_dir).where((F.col("at") >= "2024-01-15") == late).where("event_id % 3 = 0 or profile = 0")
    k, own = F.col("k"), F.col("event_type")
    band = F.when(k > (70 if late else 80), "high").when(k > 45, "medium").otherwise("low")
    done = F.when(own.isin("view", "error"), "resolved").when(own == "click", "in_review").otherwise("pending")
    said = F.when(own == "error", "false_positive").when((own == "view") & (k > 50), "confirmed_issue").when(own == "view", "inconclusive")
    segment = F.when(F.col("user_id") % 3 > 0, F.concat(F.lit("area "), (F.col("user_id") % 40).cast("string"))).when(F.lit(late), "late town").otherwise("early town")
    rows = half.select(band.alias("band"), done.alias("status"), said.alias("disposition"), segment.alias("geography"), F.when(k % 2 == 0, "R").otherwise("C").alias("kind"))
    return monitor.benchmark_metrics(rows, "geography", "kind")


def benchmark_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.benchmark_signals(_benchmark(spark, sf_dir, False), _benchmark(spark, sf_dir, True))


def benchmark_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of two runs: the second half of the events against the first, and against itself."""
    first, second = _benchmark(spark, sf_dir, False), _benchmark(spark, sf_dir, True)
    parts = [monitor.benchmark_signals(a, b).withColumn("run_id", F.lit(run)) for run, a, b in (("later", first, second), ("same", second, second))]
    return monitor.trend_rows(parts[0].unionByName(parts[1]), ["run_id"])


WINDOWS = {"1d": "1 day", "7d": "7 days", "30d": "30 days"}


def load_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.windowed_runs(_runs(spark, sf_dir), ["profile"], "at", "seconds", F.col("ok"), _now(), WINDOWS)


def load_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All families of load metrics of each user: the last day's seconds, settings and largest setting against the nearest-rank
    medians of the successful runs in the 30 days before it; failures, hours since a success and since a purchase, and clicks as they are.
    """
    runs = _runs(spark, sf_dir).where("user_id is not null")
    split = _now() - F.expr("interval 1 day")
    late, past = F.col("at") > split, F.col("ok") & (F.col("at") <= split)
    measure = lambda name, c: F.struct(F.lit(name).alias("measure"), c.cast("double").alias("x"))
    long = runs.select("user_id", late.alias("late"), past.alias("past"), F.inline(F.array(measure("seconds", F.col("seconds")), measure("k", F.col("k")))))
    sums = {"late_sum": F.when(F.col("late"), F.col("x")), "late_n": F.when(F.col("late") & F.col("x").isNotNull(), 1).otherwise(0)}
    found = order_statistics(long.withColumn("past_x", F.when(F.col("past"), F.col("x"))), ["user_id", "measure"], "past_x", {"baseline": nearest_rank(0.5)}, sums)
    mean = F.round(F.try_divide(F.col("late_sum"), F.col("late_n")), 4)
    named = F.when(F.col("measure") == "seconds", F.array(F.lit("duration"))).otherwise(F.array(F.lit("volume"), F.lit("queue_size")))
    relative = found.select("user_id", F.explode(named).alias("family"), mean.alias("value"), "baseline", F.col("n").alias("history"))
    seconds = lambda cond: F.unix_timestamp(_now()) - F.unix_timestamp(F.max(F.when(cond, F.col("at"))))
    hours = lambda cond: F.floor((seconds(cond) * 200 + 3600) / 7200) / 100.0  # noqa: E731  two digits, ties half up in whole numbers
    n = F.count("*")
    own = runs.groupBy("user_id").agg(
        n.alias("n"), F.round(F.count_if(~F.col("ok")) / n, 4).alias("failed"), hours(F.col("ok") & (F.col("k") > 50)).alias("scored"), hours(F.col("event_type") == "purchase").alias("bought"), F.count_if(F.col("event_type") == "click").cast("double").alias("clicks"),
    )
    one = lambda family, c: F.struct(F.lit(family).alias("family"), F.col(c).alias("value"), F.lit(None).cast("double").alias("baseline"), F.col("n").alias("history"))
    single = own.select("user_id", F.inline(F.array(one("failure_rate", "failed"), one("freshness.hours_since_last_successful_score_pipeline", "scored"), one("freshness", "bought"), one("case_review_in_review_count", "clicks"))))
    rows = relative.unionByName(single)
    severity, reason = monitor.load_severity(F.col("family"), F.col("value"), F.col("baseline"), F.col("history"))
    return rows.select("user_id", "family", "value", "baseline", severity.alias("severity"), reason.alias("reason"))


def failure_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's day is a run and its events are stages: runs with a failed and with a blocked (signup) stage."""
    stages = F.collect_set("event_type").alias("stages")
    runs = _runs(spark, sf_dir).groupBy("profile", "user_id", F.to_date("at").alias("day")).agg(stages)
    any_of = lambda t: F.exists("stages", lambda x: x == t)
    return runs.groupBy("profile").agg(F.count("*").alias("n"), F.round(F.count_if(any_of("error")) / F.count("*"), 4).alias("failed"), F.round(F.count_if(any_of("signup")) / F.count("*"), 4).alias("blocked"))


def freshness_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.freshness(_runs(spark, sf_dir), ["profile", "event_type"], "at", F.col("k") > 10, _now())


SLI = {"1h": "1 hour", "6h": "6 hours", "24h": "24 hours", "w": "28 days", "365d": "365 days"}


def sli_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.compliance(_runs(spark, sf_dir), ["profile"], "at", F.col("ok"), _now(), SLI)


def burn_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.burn_rates(sli_compliance(spark, sf_dir), 0.8)


def panel_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_type = monitor.compliance(_runs(spark, sf_dir), ["profile", "event_type"], "at", F.col("k") > 20, _now(), SLI)
    return monitor.panel_status(monitor.burn_rates(by_type, 0.78), "event_type")


def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event, window and budget rows of a service level for each kind of event, written as series, read back; values as texts.

    The series of the last day is written twice, the second time without its zeros; other days keep their files.
    """
    kind = F.col("event_type")
    events = _runs(spark, sf_dir).select(F.concat(F.lit("refresh."), kind).alias("sli"), F.col("at").alias("observed_at"), (F.col("k") > 20).alias("passed"), F.concat(F.lit("=p"), F.col("profile").cast("string")).alias("profile_name"))
    specs = [(f"refresh.{t}", "refresh", p, g, w) for t, p, g, w in (("view", None, 0.9, "28d"), ("click", "daily", 0.78, "365d"), ("error", None, 1.0, "28d"), ("purchase", "annual, all", 0.5, "365d"))]
    targets = spark.createDataFrame(specs, "sli string, domain string, profile_name string, target double, window string")
    found = monitor.metric_records(events, _now(), "test", targets)
    day = F.date_format("observed_at", "yyyy-MM-dd")
    rows = found.select(*[c for c in sinks.SERIES_COLUMNS if c != "observed_at_utc"], F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("observed_at_utc"), day.alias("day"))
    folder = scratch(spark, "series")
    sinks.write_series(rows, folder, "day")
    sinks.write_series(rows.where(f"day = '{NOW[:10]}' and (value <> 0 or value is null)"), folder, "day")
    return sinks.read_series(spark, folder)


def asof_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly checks from the first event to now: passed if the last purchase is at most 24 hours old."""
    runs = _runs(spark, sf_dir)
    grid = runs.groupBy("profile").agg(F.min(F.date_trunc("hour", "at")).alias("a")).select("profile", F.explode(F.sequence(F.col("a"), _now(), F.expr("interval 1 hour"))).alias("at"))
    seen = order.as_of(grid, runs.where("event_type = 'purchase'").select("profile", "at"), ["profile"], "at")
    age = (F.unix_timestamp("at") - F.unix_timestamp("last_at")) / 3600.0
    return seen.select("profile", F.col("at").alias("check_at"), "last_at", F.coalesce(age <= 24, F.lit(False)).alias("passed"))


def missing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and event types without an event of a large setting."""
    runs = _runs(spark, sf_dir)
    expected = runs.select("user_id").distinct().crossJoin(F.broadcast(runs.select("event_type").distinct()))  # five event types
    expected = expected.withColumn("source", F.concat_ws("|", "user_id", "event_type"))
    return monitor.missing_sources(expected, runs.where("k > 80").select(F.concat_ws("|", "user_id", "event_type").alias("source")), "source").select("source")


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass or fail of each run by the latency limit of its profile; runs of one user in one hour count once, the first."""
    limit = F.when(F.col("profile") == 0, 10).when(F.col("profile") == 1, 20).otherwise(40)
    rows = _runs(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "at"))
    first = pick.largest_row(rows.withColumn("older", -F.col("event_id")), ["user_id", "hour"], ["older"], ["event_id", "profile", "seconds", "ok"])
    return first.select("user_id", "hour", "event_id", "ok", (F.col("ok") & (F.col("seconds") <= limit)).alias("in_time"))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three payload shapes from the events: errors, slow purchases, and large settings."""
    r = _runs(spark, sf_dir)
    none = F.lit(None).cast("string")
    a = alerts.canonical(r.where("event_type = 'error'"), "drift", F.col("event_id"), F.lit("parser_drift"), F.when(F.col("k") > 50, "error").otherwise("warn"), F.array(F.lit("z_code"), F.when(F.col("k") > 90, "a_code").otherwise(none)), F.col("at"))
    b = alerts.canonical(r.where("event_type = 'purchase'"), "load", F.col("event_id"), F.lit("load_monitor"), F.when(F.col("seconds") > 20, "critical").otherwise("info"), F.array(F.lit("slow"), F.lit("slow")), F.col("at"))
    c = alerts.canonical(r.where("event_type = 'signup' and k > 70"), "bench", F.col("event_id"), F.lit("benchmark"), F.lit("warn"), F.array(none), F.col("at"))
    return a.unionByName(b).unionByName(c)


def alert_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir)


def alert_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("*.critical", ["chat.critical", "pager", "mail.oncall"]), ("*.warn", ["chat.warn", "mail.team"]), ("*.info", ["chat.info"]), ("load_monitor.*", ["mail.load"]), ("parser_drift.critical", ["pager"])]
    routes = spark.createDataFrame(rows, "route_key string, destinations array<string>")
    sent = _alerts(spark, sf_dir).where("at < '2024-01-10'").select("event_id", F.lit("pager").alias("destination"))
    return alerts.fan_out(_alerts(spark, sf_dir), routes, sent)


def escalations_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _alerts(spark, sf_dir).where("severity <> 'info'")
    critical = F.col("severity") == "critical"
    made = rows.select("event_id", F.col("at").alias("first_at"), F.when(critical, 1814400).otherwise(864000).alias("ack_seconds"), F.when(critical, F.array(F.lit(900), F.lit(172800))).otherwise(F.array(F.lit(345600))).alias("offsets"), "system")
    fired = made.where("system = 'load'").select("event_id", F.lit(900).alias("offset"))
    return alerts.escalations_due(made, fired, _now())


_ISSUES = """l as (
  select l_orderkey || '|' || l_linenumber as key, l_partkey as parcel_id, case when l_quantity <> 7 then year(l_shipdate) end as year, l_quantity as q, cast(l_partkey as decimal(14,2)) as base, cast(l_extendedprice as decimal(14,2)) as cents,
         case when l_quantity = 49 then make_date(year(l_shipdate) + 10, 1, 2) when l_quantity = 2 then make_date(year(l_shipdate) + 1, 6, 1) when l_quantity <> 3 then make_date(1982 + l_partkey % 9, 1, 1) end as day
  from lineitem where l_linenumber <= 3),
a as (
  select key, parcel_id, year, day, case when parcel_id % 3 > 0 then 'R' end as cls, case when q = 11 then -base else base end as acres, case when q <> 12 then base + 10 end as land,
         case when q > 45 then cents - 30000 else base end as improved, case when q = 13 then -base else base * 2 + 10 end as total from l),
t as (select *, year - dense_rank() over (partition by parcel_id, day, cls, acres, land, improved, total order by year nulls first) as island from a where day is not null),
r as (select *, year is not null and max(year) over w - min(year) over w + 1 >= 5 as carried from t window w as (partition by parcel_id, day, cls, acres, land, improved, total, island)),
iss as (
  select 'suspicious_assessment_dates' as "check", key, case when day > date '2001-01-01' then 'future_assessment_date' when year(day) > year then 'assessment_date_after_year'
         when year(day) < year - 4 and not carried then 'stale_assessment_date' end as code from r where code is not null
  union all select 'impossible_numeric_values', key, unnest(list_filter([case when acres < 0 then 'negative_assessment_value' end, case when land < 0 then 'negative_assessment_value' end, case when improved < 0 then 'negative_assessment_value' end,
    case when total < 0 then 'negative_assessment_value' end, case when total < land + improved then 'assessment_total_less_than_components' end], lambda x: x is not null)) from a
  union all select 'impossible_numeric_values', l_orderkey || '|' || l_linenumber, 'negative_tax_amount' from lineitem where l_linenumber = 4 and l_tax < 0.01
  union all select 'impossible_numeric_values', l_orderkey || '|' || l_linenumber, 'negative_payment_amount' from lineitem where l_linenumber = 5 and l_discount < 0.01
  union all select 'duplicate_parcel_summaries', cast(l_partkey as varchar), 'duplicate_parcel_summary' from lineitem where l_quantity = 50 group by l_partkey having count(*) > 1)"""

_COMPLY = """comply as (
  select profile, count(*) filter (where at_ >= timestamp '2024-01-30 23:00:00' and ok) as pass_1h, count(*) filter (where at_ >= timestamp '2024-01-30 23:00:00') as total_1h,
         count(*) filter (where at_ >= timestamp '2024-01-30 18:00:00' and ok) as pass_6h, count(*) filter (where at_ >= timestamp '2024-01-30 18:00:00') as total_6h,
         count(*) filter (where at_ >= timestamp '2024-01-30 00:00:00' and ok) as pass_24h, count(*) filter (where at_ >= timestamp '2024-01-30 00:00:00') as total_24h,
         count(*) filter (where at_ >= timestamp '2024-01-03 00:00:00' and ok) as pass_w, count(*) filter (where at_ >= timestamp '2024-01-03 00:00:00') as total_w,
         count(*) filter (where at_ >= timestamp '2023-01-31 00:00:00' and ok) as pass_365d, count(*) filter (where at_ >= timestamp '2023-01-31 00:00:00') as total_365d
  from runs group by profile)"""


def _burn_sql(source: str, target: str) -> str:
    return f"""b0 as (
  select *, round(coalesce(cast(total_1h - pass_1h as double) / nullif(total_1h * (1 - {target}), 0), 0), 6) as burn_1h,
         round(coalesce(cast(total_6h - pass_6h as double) / nullif(total_6h * (1 - {target}), 0), 0), 6) as burn_6h,
         round(coalesce(cast(total_24h - pass_24h as double) / nullif(total_24h * (1 - {target}), 0), 0), 6) as burn_24h, pass_w / nullif(total_w, 0) as obs from {source}),
b1 as (
  select * exclude (obs), round(obs, 6) as observed, round(coalesce(greatest(0.0, least(1.0, 1 - (1 - obs) / (1 - {target}))), 1.0), 6) as budget_left,
         total_w > 0 and total_6h < 20 and total_24h < 20 as insufficient from b0),
b2 as (
  select *, case when insufficient then null when total_6h >= 20 and burn_1h >= 14 and burn_6h >= 7 then 'critical'
         when total_24h >= 20 and burn_6h >= 4 and burn_24h >= 2 then 'warn' when total_24h >= 20 and burn_24h >= 1 and 28.0 / burn_24h < 21 then 'info' end as burn_severity from b1),
burn as (select *, case when observed < {target} then 'breached' when burn_severity is not null then 'burning' else 'ok' end as status from b2)"""


_DRIFT = f"""{parcels.snapshot_sql(False, "early")}, {parcels.snapshot_sql(True, "late")},
w as (
  select coalesce(b.metric, c.metric) as metric, b.den as bd, c.den as cd, round(cast(b.num as double) / nullif(b.den, 0), 4) as base_value, round(cast(c.num as double) / nullif(c.den, 0), 4) as current_value
  from early b full join late c on b.metric = c.metric),
d as (select *, round(current_value - base_value, 4) as delta, case when coalesce(bd, 0) = 0 or coalesce(cd, 0) = 0 then 'insufficient_denominator' end as ign from w),
s as (
  select *, case when metric = 'coverage.parse_error_successful_fetch_rate' then case when delta >= 0.03 then 'error' when delta >= 0.01 then 'warn' else 'ok' end
    when starts_with(metric, 'selector_miss.') then case when delta >= 0.05 then 'error' when delta >= 0.02 then 'warn' else 'ok' end
    when starts_with(metric, 'extraction_null_rate.') then case when delta >= 0.08 then 'error' when delta >= 0.03 then 'warn' else 'ok' end
    else case when -delta >= 0.05 then 'error' when -delta >= 0.02 then 'warn' else 'ok' end end as raw from d),
diff as (select *, case when ign is not null then 'ok' when raw = 'error' and cd < 25 then 'warn' else raw end as severity from s),
signals as (
  select metric, base_value, current_value, delta, severity, coalesce(ign, case severity when 'error' then 'error_threshold' when 'warn' then 'warn_threshold' else 'no_drift' end) as reason from diff)"""

_BENCH = """q as (
  select ts >= timestamp '2024-01-15' as late, case when k > case when ts >= timestamp '2024-01-15' then 70 else 80 end then 'high' when k > 45 then 'medium' else 'low' end as band,
         event_type in ('view', 'error') as reviewed, case when event_type = 'error' then 'false_positive' when event_type = 'view' and k > 50 then 'confirmed_issue' end as said,
         case when user_id % 3 > 0 then 'area ' || (user_id % 40) when ts >= timestamp '2024-01-15' then 'late town' else 'early town' end || '::' || case when k % 2 = 0 then 'R' else 'C' end as seg
  from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events) where event_id % 3 = 0 or user_id % 3 = 0),
g as (
  select late, seg, count(*) as n, count(*) filter (where reviewed) as r, count(*) filter (where band = 'high') as hi, count(*) filter (where band = 'medium') as me, count(*) filter (where said = 'false_positive') as fp,
         count(*) filter (where said = 'confirmed_issue') as ci from q group by grouping sets ((late), (late, seg))),
m as (
  select late, unnest(['coverage.review_rate', 'risk_band_mix.high.rate', 'risk_band_mix.medium.rate', 'disposition_mix.false_positive.rate', 'disposition_mix.confirmed_issue.rate']) as metric,
         unnest([round(r / n, 4), round(hi / n, 4), round(me / n, 4), round(fp / nullif(r, 0), 4), round(ci / nullif(r, 0), 4)]) as value, unnest([n, n, n, r, r]) as sample, n as queue_count from g where seg is null
  union all
  select late, 'segment.' || seg || unnest(['.disposition_mix.false_positive.rate_delta_abs', '.risk_band_mix.high.rate_delta_abs']), unnest([round(fp / nullif(r, 0), 4), round(hi / n, 4)]), unnest([r, n]), n from g where seg is not null),
d as (
  select coalesce(b.metric, c.metric) as metric, b.value as base_value, c.value as current_value, coalesce(c.sample, 0) as sample, coalesce(c.queue_count, 0) as queue_count,
         round(case when ends_with(coalesce(b.metric, c.metric), 'rate_delta_abs') then abs(c.value - b.value) else c.value - b.value end, 4) as delta
  from (select * from m where not late) b full join (select * from m where late) c on b.metric = c.metric),
s as (
  select *, case when base_value is null and current_value is null then 'non_comparable' when base_value is null then 'baseline_missing' when current_value is null then 'current_missing'
    when metric like '%disposition_mix.%' and sample < 20 then 'low_sample_size' when metric like 'segment.%' and queue_count < 25 then 'low_sample_size' end as ign,
    case when metric = 'coverage.review_rate' then case when -delta >= 0.2 then 'critical' when -delta >= 0.1 then 'warn' else 'ok' end
      when metric = 'risk_band_mix.high.rate' then case when delta >= 0.08 then 'critical' when delta >= 0.04 then 'warn' else 'ok' end
      when metric = 'risk_band_mix.medium.rate' then case when abs(delta) >= 0.1 then 'critical' when abs(delta) >= 0.06 then 'warn' else 'ok' end
      when metric = 'disposition_mix.false_positive.rate' then case when delta >= 0.06 then 'critical' when delta >= 0.03 then 'warn' else 'ok' end
      when metric = 'disposition_mix.confirmed_issue.rate' then case when -delta >= 0.06 then 'critical' when -delta >= 0.03 then 'warn' else 'ok' end
      else case when delta >= 0.12 then 'critical' when delta >= 0.07 then 'warn' else 'ok' end end as raw from d),
signals as (
  select metric, base_value, current_value, delta, sample, case when ign is not null then 'ok' else raw end as severity,
         case when metric like 'segment.%' then 'segment_mix' else split_part(metric, '.', 1) end || '.' || coalesce(ign, case when delta = 0 then 'no_change' when raw = 'ok' then 'within_tolerance' else 'beyond_tolerance' end) || '.' || metric as reason,
         ign is not null as ignored from s)"""

_ALERTS = """raw as (
  select 'drift' as system, event_id, 'parser_drift' as alert_type, case when k > 50 then 'critical' else 'warn' end as severity, case when k > 90 then 'a_code,z_code' else 'z_code' end as reasons, at_ as "at" from runs where event_type = 'error'
  union all select 'load', event_id, 'load_monitor', case when seconds > 20 then 'critical' else 'info' end, 'slow', at_ from runs where event_type = 'purchase'
  union all select 'bench', event_id, 'benchmark', 'warn', '', at_ from runs where event_type = 'signup' and k > 70),
al as (
  select system, cast(event_id as varchar) as alert_id, alert_type, severity, reasons, "at",
         'evt_' || substr(sha256(system || '|' || event_id || '|' || sha256(alert_type || '|' || severity || '|' || reasons)), 1, 20) as event_id from raw)"""

QUERIES = {f.__name__: f for f in (
    quality_issues, quality_report, lineage_issues, fetch_consistency, payment_semantics, anomalies, data_profile, section_gaps, drift_snapshot, drift_diff, drift_alerts,
    benchmark_signals, benchmark_trend, load_rollups, load_signals, failure_fractions, freshness_hours, sli_compliance, burn_rates, panel_status, metric_rows, asof_freshness, missing_sources,
    run_events, alert_canonical, alert_fanout, escalations_due,
)}

SQL = {
    "quality_issues": f"with {_ISSUES} select \"check\", key, code, count(*) as n from iss group by all",
    "quality_report": f"""with {_ISSUES}, c as (select unnest(['suspicious_assessment_dates', 'impossible_numeric_values', 'duplicate_parcel_summaries', 'lineage_consistency']) as name)
select name as "check", count(code) as issue_count, count(code) = 0 as passed from c left join iss on name = "check" group by name""",
    "lineage_issues": """with e as (select cast(o_custkey as varchar) as a, cast(l_partkey as varchar) as b, o_orderpriority as kind from lineitem join orders on o_orderkey = l_orderkey),
i as (
  select a || '|' || b as key, 'invalid_lineage_relationship_type' as code from e where kind = '5-LOW' union all select a || '|' || b, 'self_referential_lineage_link' from e where a = b
  union all select a || '|' || b, 'conflicting_lineage_relationship' from e group by a, b having count(distinct kind) > 1)
select 'lineage_consistency' as "check", key, code, count(*) as n from i group by all""",
    "fetch_consistency": """with c as (select l_orderkey, count(*) as n from lineitem group by all),
r as (select o_orderkey, o_orderstatus <> 'P' as ok, o_totalprice > 100000 as parsed, coalesce(n, 0) as n from orders left join c on l_orderkey = o_orderkey),
i as (
  select o_orderkey, 'success_not_parsed' as code from r where ok and not parsed and n > 5 union all select o_orderkey, 'failed_but_parsed' from r where not ok and parsed
  union all select o_orderkey, 'parsed_without_rows' from r where parsed and n = 0 union all select o_orderkey, 'rows_without_parse' from r where not parsed and n > 6)
select 'fetch_parse' as "check", cast(o_orderkey as varchar) as key, code from i""",
    "payment_semantics": """with s as (select l_orderkey, min(l_linestatus) as s, max(l_shipdate) as last from lineitem where l_discount > 0.02 group by all),
r as (select o_orderkey, case when o_orderstatus <> 'P' then o_orderstatus end as own, s, last, o_orderdate from orders left join s on l_orderkey = o_orderkey),
i as (
  select o_orderkey, 'status_mismatch' as code from r where own is distinct from s union all select o_orderkey, 'missing_rows' from r where last is null
  union all select o_orderkey, 'date_before_order' from r where last < o_orderdate)
select 'payment_semantics' as "check", cast(o_orderkey as varchar) as key, code from i""",
    "anomalies": """with f as (
  select c_custkey as id, count(*) filter (where o_orderstatus = 'F') as a, count(*) filter (where o_orderstatus = 'O') as t, count(*) filter (where o_orderstatus = 'P') as p,
         coalesce(bool_or(o_orderstatus = 'F' and o_totalprice < 5000), false) as na, coalesce(bool_or(o_orderstatus = 'O' and o_totalprice < 2000), false) as nt,
         coalesce(bool_or(o_orderstatus = 'P' and o_totalprice < 1500), false) as np
  from customer left join orders on o_custkey = c_custkey group by all)
select id, 'missing_assessment' as anomaly from f where a = 0 union all select id, 'negative_assessment' from f where na union all select id, 'missing_tax' from f where t = 0
union all select id, 'negative_tax' from f where nt union all select id, 'missing_payment' from f where p = 0 union all select id, 'negative_payment' from f where np""",
    "data_profile": """select lang, count(*) as n, count(distinct source) as n_sources, count(l.doc_id) as n_labelled, count(*) - count(l.doc_id) as n_gap, round(count(l.doc_id) / count(*), 4) as coverage,
       round(count(*) filter (where n_chars > 500) / count(*), 4) as long_rate from documents d left join (select distinct doc_id from labels) l on l.doc_id = d.doc_id group by lang""",
    "section_gaps": "select 'no_label' as gap, doc_id from documents where doc_id not in (select doc_id from labels) union all select 'no_document', doc_id from labels where doc_id not in (select doc_id from documents)",
    "drift_snapshot": f"with {parcels.snapshot_sql(True, 'm')} select metric, num, den, {parcels._RATE} as rate from m",
    "drift_diff": f"with {_DRIFT} select * from signals",
    "drift_alerts": f"""with {_DRIFT},
f as (select *, split_part(metric, '.', 1) as family, case severity when 'error' then 2 when 'warn' then 1 else 0 end as r from signals where severity <> 'ok'),
t as (select family, max(r) as r from f group by all)
select f.family, severity, string_agg(distinct reason, ',' order by reason) as reasons, count(*) as n_signals from f join t on t.family = f.family and t.r = f.r group by f.family, severity""",
    "benchmark_signals": f"with {_BENCH} select * from signals",
    "benchmark_trend": f"""with {_BENCH},
same as (
  select metric, value as base_value, value as current_value, value - value as delta, 'ok' as severity,
         value is null or (metric like '%disposition_mix.%' and sample < 20) or (metric like 'segment.%' and queue_count < 25) as ignored from m where late),
series as (select 'later' as run_id, metric, base_value, current_value, delta, severity, ignored from signals union all select 'same', * from same)
select *, case when bool_or(severity = 'critical') over w then 'critical' when bool_or(severity = 'warn') over w then 'warn' else 'ok' end as overall_severity
from series window w as (partition by run_id)""",
    "load_rollups": f"""with {_RUNS}, win as (select unnest(['1d', '7d', '30d']) as w, unnest([1, 7, 30]) as days),
x as (select * from runs join win on at_ > timestamp '{NOW}' - to_days(days) and at_ <= timestamp '{NOW}')
select profile, w as "window", count(*) as n, count(*) filter (where not ok) as n_failed, case when count(seconds) filter (where ok) >= 5 then quantile_disc(case when ok then seconds end, 0.5) end as p50,
       case when count(seconds) filter (where ok) >= 5 then quantile_disc(case when ok then seconds end, 0.95) end as p95, round(count(*) filter (where not ok) / count(*), 4) as failed_fraction
from x group by all""",
    "load_signals": f"""with {_RUNS},
x as (select user_id, at_ > timestamp '{NOW}' - interval 1 day as late, ok and at_ <= timestamp '{NOW}' - interval 1 day as past, unnest(['seconds', 'k']) as measure, unnest([cast(seconds as double), cast(k as double)]) as x from runs where user_id is not null),
u as (select user_id, measure, quantile_disc(case when past then x end, 0.5) as baseline, count(x) filter (where past) as history, round(avg(x) filter (where late), 4) as value from x group by all),
o as (
  select user_id, count(*) as n, round(count(*) filter (where not ok) / count(*), 4) as failed, floor(((floor(epoch(timestamp '{NOW}')) - floor(epoch(max(at_) filter (where ok and k > 50)))) * 200 + 3600) / 7200) / 100.0 as scored,
         floor(((floor(epoch(timestamp '{NOW}')) - floor(epoch(max(at_) filter (where event_type = 'purchase')))) * 200 + 3600) / 7200) / 100.0 as bought, cast(count(*) filter (where event_type = 'click') as double) as clicks from runs where user_id is not null group by all),
l as (
  select user_id, 'duration' as family, value, baseline, history from u where measure = 'seconds' union all select user_id, 'volume', value, baseline, history from u where measure = 'k'
  union all select user_id, 'queue_size', value, baseline, history from u where measure = 'k' union all select user_id, 'failure_rate', failed, null, n from o
  union all select user_id, 'freshness.hours_since_last_successful_score_pipeline', scored, null, n from o union all select user_id, 'freshness', bought, null, n from o union all select user_id, 'case_review_in_review_count', clicks, null, n from o),
g as (
  select *, (value - baseline) / nullif(baseline, 0) as delta, family in ('duration', 'volume', 'queue_size') as rel from l),
h as (
  select *, case when value is null and (starts_with(family, 'freshness') or family = 'failure_rate') then 'ignored_insufficient_history' when value is null then 'ignored_missing_subject_value'
         when (rel or family = 'failure_rate') and history < 3 then 'ignored_insufficient_history' when rel and coalesce(baseline, 0) = 0 then 'ignored_invalid_baseline' end as ign,
         case family when 'duration' then case when delta >= 1 then 'critical' when delta >= 0.5 then 'warn' else 'ok' end when 'volume' then case when abs(delta) >= 0.6 then 'critical' when abs(delta) >= 0.35 then 'warn' else 'ok' end
           when 'queue_size' then case when abs(delta) >= 0.6 then 'critical' when abs(delta) >= 0.35 then 'warn' else 'ok' end when 'failure_rate' then case when value >= 0.2 then 'critical' when value >= 0.1 then 'warn' else 'ok' end
           when 'freshness' then case when value >= 72 then 'critical' when value >= 48 then 'warn' else 'ok' end when 'case_review_in_review_count' then case when value >= 50 then 'critical' when value >= 25 then 'warn' else 'ok' end
           else case when value >= 60 then 'critical' when value >= 36 then 'warn' else 'ok' end end as sev from g),
i as (select *, case when ign is not null then 'ok' else sev end as severity from h)
select user_id, family, value, baseline, severity, coalesce(ign, case when severity = 'ok' then 'ok_within_threshold' else severity || case when starts_with(family, 'freshness') then '_freshness' when family = 'failure_rate' then '_failure_rate' else '_relative_delta' end end) as reason from i""",
    "failure_fractions": f"""with {_RUNS}, r as (select profile, user_id, cast(at_ as date) as day, bool_or(event_type = 'error') as f, bool_or(event_type = 'signup') as b from runs group by all)
select profile, count(*) as n, round(count(*) filter (where f) / count(*), 4) as failed, round(count(*) filter (where b) / count(*), 4) as blocked from r group by all""",
    "freshness_hours": f"""with {_RUNS} select profile, event_type, round(greatest((floor(epoch(timestamp '{NOW}')) - floor(epoch(max(at_) filter (where k > 10)))) / 3600.0, 0), 2) as hours from runs group by all""",
    "sli_compliance": f"with {_RUNS}, {_COMPLY} select * from comply",
    "burn_rates": f"with {_RUNS}, {_COMPLY}, {_burn_sql('comply', '0.8')} select * from burn",
    "panel_status": f"""with {_RUNS.replace("event_type <> 'error' as ok", "cast(json_extract_string(props, '$.k') as bigint) > 20 as ok")}, {_COMPLY.replace("select profile,", "select profile, event_type,").replace("group by profile", "group by profile, event_type")}, {_burn_sql('comply', '0.78')},
r as (select event_type, case when total_w = 0 then 0 when status = 'breached' then 3 when status = 'burning' then 2 else 1 end as r from burn),
p as (select event_type as panel, r from r union all select 'overview', r from r)
select panel, case max(r) when 0 then 'no_data' when 3 then 'critical' when 2 then 'warn' else 'ok' end as status from p group by panel""",
    "metric_rows": f"""with {_RUNS},
t as (select unnest(['view', 'click', 'error', 'purchase']) as event_type, unnest([null, 'daily', null, 'annual, all']) as own, unnest([0.9, 0.78, 1.0, 0.5]) as target, unnest(['28d', '365d', '28d', '365d']) as own_window),
e as (select 'refresh.' || r.event_type as sli, own, target, own_window, at_, k > 20 as passed, '=p' || profile as profile_name from runs r join t on t.event_type = r.event_type),
w as (select unnest(['1h', '6h', '24h', '28d', '365d']) as "window", unnest([1, 6, 24, 672, 8760]) as hours),
c as (
  select sli, own, target, own_window, "window", count(*) filter (where passed and at_ >= timestamp '{NOW}' - to_hours(hours)) as num, count(*) filter (where at_ >= timestamp '{NOW}' - to_hours(hours)) as den from e, w group by all),
r as (
  select sli || '.event' as metric_id, profile_name, 'event' as "window", strftime(at_, '%Y-%m-%dT%H:%M:%SZ') as observed, case when passed then 1.0 else 0.0 end as value, case when passed then 1 else 0 end as num, 1 as den from e
  union all select sli || '.compliance', own, "window", strftime(timestamp '{NOW}', '%Y-%m-%dT%H:%M:%SZ'), round(num / nullif(den, 0), 6), num, den from c
  union all select sli || '.error_budget_remaining', own, "window", strftime(timestamp '{NOW}', '%Y-%m-%dT%H:%M:%SZ'),
    round(coalesce(greatest(0.0, least(1.0, 1 - case when target < 1 then (1 - num / nullif(den, 0)) / (1 - cast(target as double)) when num < den then 1.0 when den > 0 then 0.0 end)), 1.0), 6), null, null from c where "window" = own_window)
select metric_id, 'refresh' as domain, 'test' as environment, case when left(profile_name, 1) = '=' then '''' || profile_name else coalesce(profile_name, '') end as profile_name, "window", observed as observed_at_utc,
       coalesce(cast(cast(value as double) as varchar), '') as value, coalesce(cast(num as varchar), '') as numerator, coalesce(cast(den as varchar), '') as denominator
from r where left(observed, 10) <> '{NOW[:10]}' or value <> 0 or value is null""",
    "asof_freshness": f"""with {_RUNS}, g as (select profile, unnest(generate_series(min(date_trunc('hour', at_)), timestamp '{NOW}', interval 1 hour)) as check_at from runs group by profile),
p as (select profile, at_ from runs where event_type = 'purchase'),
j as (select g.profile, g.check_at, p.at_ as last_at from g asof left join p on p.profile = g.profile and p.at_ <= g.check_at)
select profile, check_at, last_at, coalesce(floor(epoch(check_at)) - floor(epoch(last_at)) <= 86400, false) as passed from j""",
    "missing_sources": """with e as (select u.user_id || '|' || t.event_type as source from (select distinct user_id from events) u, (select distinct event_type from events) t)
select source from e where source not in (select user_id || '|' || event_type from events where cast(json_extract_string(props, '$.k') as bigint) > 80)""",
    "run_events": f"""with {_RUNS}, f as (select *, date_trunc('hour', at_) as hour, row_number() over (partition by user_id, date_trunc('hour', at_) order by event_id) as n from runs)
select user_id, hour, event_id, ok, ok and seconds <= case profile when 0 then 10 when 1 then 20 else 40 end as in_time from f where n = 1""",
    "alert_canonical": f"with {_RUNS}, {_ALERTS} select * from al",
    "alert_fanout": f"""with {_RUNS}, {_ALERTS},
r as (select *, case when alert_type = 'parser_drift' and severity = 'critical' then 'parser_drift.critical' when alert_type = 'load_monitor' then 'load_monitor.*' else '*.' || severity end as route from al),
d as (
  select event_id, "at", route, unnest(case route when '*.critical' then ['chat.critical', 'pager', 'mail.oncall'] when '*.warn' then ['chat.warn', 'mail.team'] when '*.info' then ['chat.info']
    when 'load_monitor.*' then ['mail.load'] else ['pager'] end) as destination from r)
select event_id, route, destination from d where not (destination = 'pager' and "at" < timestamp '2024-01-10')""",
    "escalations_due": f"""with {_RUNS}, {_ALERTS},
m as (select event_id, system, floor(epoch(timestamp '{NOW}')) - floor(epoch("at")) as age, severity from al where severity <> 'info'),
d as (
  select event_id, system, age, unnest(case when severity = 'critical' then [900, 172800] else [345600] end) as "offset", case when severity = 'critical' then 1814400 else 864000 end as ack from m)
select event_id, "offset" from d where age < ack and "offset" <= age and not (system = 'load' and "offset" = 900)""",
}
