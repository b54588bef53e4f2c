"""JSON artifacts of any shape as VARIANT payloads: alerts, run events and load metrics are picked from them by path.

A field of another type than asked for is unknown and never fails the job; a document that is no JSON, or no object, is
a row with an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.functions.text import stable_id

# Profiles and their limits of seconds, states of a sign-off, load metrics and where a payload has them.
LATENCY_LIMITS = {"daily_refresh": 5400, "analysis_only": 1800, "annual_refresh": 28800}
LOAD_MONITOR_LIMIT = 600
SIGNOFF_STATES = ["approved", "pending_signoff", "rejected"]
STAGES = ["analysis_artifacts", "build_context", "health_summary", "ingest_context", "investigation_artifacts", "score_pipeline"]


def read(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(path, sha256, payload, error, and partition columns): a row for each file, or for each line of each file.

    error is bad_json, not_object or null; payload is null where there is an error.  Files without a byte, and blank lines, are no rows.
    """
    raw = spark.read.option("wholetext", not lines).text(path)
    if lines:
        raw = raw.where(F.trim("value") != "")
    parsed = F.try_parse_json("value")
    rows = raw.select(F.col("_metadata.file_path").alias("path"), F.sha2("value", 256).alias("sha256"), parsed.alias("payload"), *[c for c in raw.columns if c != "value"])
    error = F.when(F.col("payload").isNull(), "bad_json").when(~kind_of(F.col("payload")).startswith("OBJECT"), "not_object")
    return rows.withColumn("error", error).withColumn("payload", F.when(F.col("error").isNull(), F.col("payload")))


def kind_of(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def part(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def text(v: Column, path: str) -> Column:
    """The text at a path, trimmed; null unless it is a text that is not blank."""
    found = F.trim(F.try_variant_get(v, path, "string"))
    return F.when((kind_of(part(v, path)) == "STRING") & (found != ""), found)


def number(v: Column, path: str) -> Column:
    return F.when(kind_of(part(v, path)).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(v, path, "double"))


def items(v: Column, path: str) -> Column:
    """The elements of an array at a path; none if there is no array."""
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def moment(said: Column) -> Column:
    """The time of an ISO text that names its offset; null for any other."""
    return F.when(said.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d.*(Z|[+-]\d\d:?\d\d)$"), F.try_to_timestamp(said))


def time(v: Column, path: str) -> Column:
    return moment(text(v, path))


def _reasons(texts: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(texts)))


_ALERT_COLUMNS = ["source_system", "source_payload_type", "source_run_id", "alert_id", "source_alert_type", "severity", "generated_at", "summary", "reason_codes", "operator_actions", "source_routing_key"]


def alerts(artifacts: DataFrame, now: Column) -> DataFrame:
    """Canonical alerts of three payload shapes: a single alert, a list of benchmark alerts, and a scheduler's incident.

    Severities other than info, warn and critical are no alerts (benchmark alerts: warn and critical only); an error of
    parser drift is critical.  event_id depends on the system, the alert's id and the bytes of the payload, so that the
    same file read twice gives the same alert.
    """
    p = F.col("payload")
    none, no_actions = F.lit(None).cast("string"), F.array().cast("array<string>")
    level = lambda said, known: F.when(said.isin(known), said)
    every = ["info", "warn", "critical"]
    as_texts = lambda v, path: F.transform(items(v, path), lambda x: text(x, "$"))
    objects = lambda v, path: F.transform(F.filter(items(v, path), lambda x: kind_of(x).startswith("OBJECT")), lambda x: F.to_json(x))

    a = part(p, "$.alert")
    system = text(a, "$.alert_type")
    said = text(a, "$.severity")
    severity = F.when((system == "parser_drift") & (said == "error"), "critical").otherwise(level(said, every))
    single = artifacts.where(system.isin("parser_drift", "load_monitoring")).select(
        "path", "sha256", system.alias("source_system"), F.concat(system, F.lit("_alert_payload_v1")).alias("source_payload_type"),
        F.coalesce(text(p, "$.run.run_id"), text(a, "$.subject_run_id"), text(p, "$.run.scheduler_run_id")).alias("source_run_id"), text(a, "$.alert_id").alias("alert_id"), system.alias("source_alert_type"),
        severity.alias("severity"), F.coalesce(time(a, "$.generated_at"), now).alias("generated_at"), F.coalesce(text(a, "$.summary"), F.concat_ws(" ", system, severity, F.lit("alert"))).alias("summary"),
        _reasons(as_texts(a, "$.reason_codes")).alias("reason_codes"), objects(p, "$.operator_actions").alias("operator_actions"), text(a, "$.routing_key").alias("source_routing_key"),
    )
    b, at = F.col("b"), F.col("at")
    listed = artifacts.where(p.isNotNull()).select("path", "sha256", F.posexplode(items(p, "$.alerts")).alias("at", "b"))
    own_id = F.coalesce(text(b, "$.alert_id"), F.format_string("benchmark_pack_alert_%03d", at))
    run = F.when(F.instr(own_id, ".alert.") > 0, F.substring_index(own_id, ".alert.", 1))
    listed = listed.select(
        "path", "sha256", F.lit("benchmark_pack").alias("source_system"), F.lit("benchmark_pack_alert_payload_v1").alias("source_payload_type"), run.alias("source_run_id"), own_id.alias("alert_id"),
        F.coalesce(text(b, "$.alert_type"), F.lit("benchmark_pack")).alias("source_alert_type"), level(text(b, "$.severity"), every[1:]).alias("severity"), F.coalesce(time(b, "$.generated_at"), now).alias("generated_at"),
        F.coalesce(text(b, "$.summary"), F.lit("benchmark_pack alert")).alias("summary"), _reasons(as_texts(b, "$.reason_codes")).alias("reason_codes"), no_actions.alias("operator_actions"), text(b, "$.routing_key").alias("source_routing_key"),
    )
    i, r = part(p, "$.incident"), part(p, "$.result")
    advice = text(r, "$.recommended_operator_action_summary")
    action = F.to_json(F.struct(F.lit("follow_scheduler_recommendation").alias("action_id"), advice.alias("message"), F.array().cast("array<string>").alias("artifact_paths")))
    incident = artifacts.where(i.isNotNull()).select(
        "path", "sha256", F.lit("scheduler").alias("source_system"), F.lit("scheduler_payload_v1").alias("source_payload_type"), text(p, "$.scheduler_run.scheduler_run_id").alias("source_run_id"),
        text(i, "$.incident_id").alias("alert_id"), F.lit("scheduler").alias("source_alert_type"), level(text(i, "$.severity"), every).alias("severity"), F.coalesce(time(i, "$.opened_at_utc"), now).alias("generated_at"),
        F.coalesce(text(r, "$.failure_message"), advice, F.lit("scheduler incident")).alias("summary"), _reasons(F.array(text(r, "$.failure_code"), text(r, "$.failure_class"))).alias("reason_codes"),
        F.when(advice.isNotNull(), F.array(action)).otherwise(no_actions).alias("operator_actions"), none.alias("source_routing_key"),
    )
    rows = single.unionByName(listed).unionByName(incident).where("severity is not null and alert_id is not null")
    return rows.select(stable_id("evt_", F.col("source_system"), F.col("alert_id"), F.col("sha256")).alias("event_id"), "path", "sha256", *_ALERT_COLUMNS)


def _events(sli: Column, at: Column, passed: Column, profile: Column) -> Column:
    return F.struct(sli.alias("sli"), at.alias("observed_at"), F.coalesce(passed, F.lit(False)).alias("passed"), profile.alias("profile_name"))


def _of_profile(name: str, profile: Column) -> Column:
    return F.concat(F.lit(name), profile)


def run_events(artifacts: DataFrame, now: Column, domain: str = "domain") -> DataFrame:
    """(sli, observed_at, passed, profile_name) of refresh, scheduler, parser_drift, load_monitoring, annual_signoff and
    benchmark_pack artifacts, which the column ``domain`` tells apart.

    Cancelled runs and unknown profiles have no events.  A scheduler's run that a refresh artifact tells of is left out;
    of several that tell of one run the first by path and bytes counts.
    """
    p, no_profile = F.col("payload"), F.lit(None).cast("string")
    of = lambda name: artifacts.where(F.col(domain) == name)
    limit = reduce(lambda c, kv: c.when(F.col("profile") == kv[0], kv[1]), LATENCY_LIMITS.items(), F.when(F.lit(False), 0))
    seconds = lambda a, b: F.unix_micros(b) / 1e6 - F.unix_micros(a) / 1e6

    def timed(rows: DataFrame, *more: Column) -> DataFrame:
        """rows (profile, status, at, started, finished) as events of success and latency, and more."""
        ok = F.col("status") == "succeeded"
        both = [_events(_of_profile("refresh.success_ratio.", F.col("profile")), F.col("at"), ok, F.col("profile")), _events(_of_profile("refresh.latency_compliance.", F.col("profile")), F.col("at"), ok & (seconds(F.col("started"), F.col("finished")) <= limit), F.col("profile"))]
        return rows.select(F.inline(F.array_compact(F.array(*both, *more))))

    known = lambda c: F.col(c).isin(list(LATENCY_LIMITS))
    run = of("refresh").select(
        text(p, "$.run.profile_name").alias("profile"), text(p, "$.run.status").alias("status"), F.coalesce(text(p, "$.run.run_id"), F.col("path")).alias("run_id"),
        time(p, "$.run.started_at").alias("started"), time(p, "$.run.finished_at").alias("finished"), F.filter(items(p, "$.stages"), lambda s: kind_of(s).startswith("OBJECT")).alias("stages"),
    ).where(known("profile") & ~F.col("status").eqNullSafe("cancelled")).withColumn("at", F.coalesce("finished", "started", now))
    complete = (F.size("stages") > 0) & F.forall("stages", lambda s: text(s, "$.status").eqNullSafe(F.lit("succeeded")))
    refresh = timed(run, F.when(F.col("profile") == "annual_refresh", _events(F.lit("annual_refresh.required_stage_completion_ratio"), F.col("at"), complete, F.col("profile"))))

    attempt_times = lambda name: F.transform(items(p, "$.attempts"), lambda x: time(x, f"$.{name}"))
    own = text(p, "$.scheduler_run.scheduler_run_id")
    planned = of("scheduler").select(
        "path", "sha256", text(p, "$.scheduler_run.profile_name").alias("profile"), text(p, "$.result.status").alias("status"), F.coalesce(text(p, "$.scheduler_run.refresh_run_id"), own, F.col("path")).alias("run_id"),
        F.coalesce(time(p, "$.result.last_attempt_finished_at_utc"), time(p, "$.scheduler_run.updated_at_utc"), now).alias("at"),
        F.array_min(attempt_times("started_at_utc")).alias("started"), F.array_max(attempt_times("finished_at_utc")).alias("finished"),
    ).where(known("profile") & F.col("status").isNotNull() & (F.col("status") != "cancelled"))
    once = planned.groupBy("profile", "run_id").agg(F.min_by(F.struct("status", "at", "started", "finished"), F.struct("path", "sha256")).alias("first")).select("profile", "run_id", "first.*")
    scheduler = timed(once.join(run.select("profile", "run_id").distinct(), ["profile", "run_id"], "left_anti"))

    status = text(p, "$.run.status")
    ok = status == "succeeded"
    at = F.coalesce(time(p, "$.run.generated_at"), now)
    error = F.exists(items(p, "$.alerts"), lambda x: text(x, "$.severity").eqNullSafe(F.lit("error")))
    paths = text(p, "$.baseline.artifact_path").isNotNull() & text(p, "$.current.artifact_path").isNotNull()
    drift = of("parser_drift").where(text(p, "$.run.run_type") == "parser_drift_diff").select(F.inline(F.array(
        _events(F.lit("parser_drift.error_free_ratio"), at, ok & ~error, no_profile), _events(F.lit("parser_drift.artifact_coverage"), at, ok & paths, no_profile))))
    started, finished = time(p, "$.run.started_at"), time(p, "$.run.finished_at")
    at = F.coalesce(finished, started, now)
    load = of("load_monitoring").where(p.isNotNull()).select(F.inline(F.array(
        _events(F.lit("load_monitoring.critical_free_ratio"), at, ok & ~text(p, "$.summary.overall_severity").eqNullSafe("critical"), no_profile),
        _events(F.lit("load_monitoring.timeliness"), at, ok & (seconds(started, finished) <= LOAD_MONITOR_LIMIT), no_profile))))
    signed = F.coalesce(time(p, "$.run.updated_at"), time(p, "$.run.created_at"), now)
    signoff = of("annual_signoff").where(status.isin(SIGNOFF_STATES)).select(_events(F.lit("annual_refresh.signoff_success_ratio"), signed, status == "approved", F.lit("annual_refresh")).alias("e")).select("e.*")
    made = F.coalesce(finished, time(p, "$.generated_at"), now)
    bench = of("benchmark_pack").where(p.isNotNull()).select(_events(F.lit("benchmark.generation_success_ratio"), made, ok, no_profile).alias("e")).select("e.*")
    return reduce(DataFrame.unionByName, [refresh, scheduler, drift, load, signoff, bench])


def load_metrics(artifacts: DataFrame) -> DataFrame:
    """(run_id, profile_name, status, at, metric, value, unavailable) of refresh artifacts: total and stage durations.

    A stage's duration is what it says, else the time between its start and end, at least 0; a stage that its profile
    skips on purpose is unavailable.  Of repeated stages the last counts.  Runs without an id or with another status than
    succeeded and failed are left out.
    """
    p = F.col("payload")

    def stage(x: Column) -> Column:
        micros = lambda path: F.unix_micros(time(x, path)) / 1e6
        between = F.greatest(micros("$.finished_at") - micros("$.started_at"), F.when(time(x, "$.finished_at").isNotNull() & time(x, "$.started_at").isNotNull(), 0.0))
        return F.named_struct(F.lit("stage"), text(x, "$.stage_id"), F.lit("status"), text(x, "$.status"), F.lit("took"), F.coalesce(number(x, "$.duration_seconds"), between))

    on_purpose = F.filter(items(p, "$.diagnostics.skip_reasons"), lambda s: text(s, "$.reason").startswith("profile_skip:"))
    skips = F.transform(on_purpose, lambda s: text(s, "$.stage_id"))
    runs = artifacts.select(
        text(p, "$.run.run_id").alias("run_id"), F.coalesce(text(p, "$.run.profile_name"), F.lit("unknown")).alias("profile_name"), text(p, "$.run.status").alias("status"),
        F.coalesce(time(p, "$.run.finished_at"), time(p, "$.run.started_at")).alias("at"), number(p, "$.summary.duration_seconds_total").alias("total"), F.transform(items(p, "$.stages"), stage).alias("stages"), skips.alias("skips"),
    ).where(F.col("run_id").isNotNull() & F.col("status").isin("succeeded", "failed"))
    runs = runs.select("*", F.explode(F.array(F.lit(None).cast("string"), *map(F.lit, STAGES))).alias("name"))  # after the stages are parsed, or each metric parses them
    own = F.try_element_at(F.filter("stages", lambda x: x["stage"] == F.col("name")), F.lit(-1))
    metric = F.coalesce(F.concat(F.lit("duration.stage."), F.col("name"), F.lit(".seconds")), F.lit("duration.total_seconds"))
    skipped = F.coalesce((own["status"] == "skipped") & F.array_contains("skips", F.col("name")), F.lit(False))
    return runs.select("run_id", "profile_name", "status", "at", metric.alias("metric"), F.when(F.col("name").isNull(), F.col("total")).otherwise(own["took"]).alias("value"), skipped.alias("unavailable"))
