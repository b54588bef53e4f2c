"""Queries over JSON artifacts: events are written as run, alert and incident documents of differing shapes and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.operators import monitor
from lotlens.operators.order import nearest_rank, order_statistics
from lotlens.runtime import cut, scratch, table
from lotlens.sources import artifacts as A

NOW = "2024-01-31 00:00:00"

# Documents as text, with %-marks for values; Spark and the SQL fill in the same ones.
_REFRESH = (
    '{"run":{"run_id":"r%d","profile_name":"%s","status":"%s","started_at":"%s","finished_at":"%s"},"summary":{"duration_seconds_total":%d},'
    '"stages":[{"stage_id":"ingest_context","status":"succeeded","duration_seconds":%d},{"stage_id":"score_pipeline","status":"%s","started_at":"%s","finished_at":"%s"},{"stage_id":"health_summary","status":"skipped"},"odd"],'
    '"diagnostics":{"skip_reasons":[{"stage_id":"health_summary","reason":"%s"}]}}'
)
_SCHEDULER = (
    '{"scheduler_run":{"profile_name":"%s","scheduler_run_id":"s%d","refresh_run_id":"r%d"},"result":{"status":"%s","last_attempt_finished_at_utc":"%s","failure_code":"z_code","failure_class":"%s"},'
    '"attempts":[{"started_at_utc":"%s","finished_at_utc":"%s"},{"started_at_utc":"soon"},3],"incident":{"incident_id":"i%d","severity":"%s","opened_at_utc":"%s"}}'
)
_ALERT = '{"alert":{"alert_type":"%s","alert_id":"a%d","severity":"%s","generated_at":"%s","reason_codes":["slow","z_code","slow",7]},"run":{"run_type":"parser_drift_diff","status":"succeeded","generated_at":"%s"},"operator_actions":[{"action_id":"look"},1],"alerts":"none"}'
_BENCH = '{"run":{"status":"%s","finished_at":"%s"},"alerts":[{"alert_id":"b%d.alert.1","severity":"critical","summary":"mix"},{"severity":"%s","reason_codes":["r%d"]},{"severity":"info"}]}'

_PROFILES = ["daily_refresh", "analysis_only", "annual_refresh", "nightly"]


def _written(spark: SparkSession, sf_dir: str) -> str:
    """A folder of JSON lines, one folder for each domain; some lines are broken or no objects."""
    e = table(spark, sf_dir, "events").withColumns({"k": F.get_json_object("props", "$.k").cast("long"), "ts": F.col("ts").cast("timestamp")})
    n, k = F.col("event_id"), F.col("k")
    iso = lambda later=0: F.date_format(F.timestamp_seconds(F.unix_seconds("ts") + later), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    profile = F.element_at(F.array(*map(F.lit, _PROFILES)), (n % 4 + 1).cast("int"))
    state = F.when(k % 10 == 0, "cancelled").when(k % 7 == 0, "failed").otherwise("succeeded")
    took = (k * 60).cast("long")
    stage = F.when(k % 5 == 0, "failed").otherwise("succeeded")
    skip = F.when(k % 2 == 0, "profile_skip:health").otherwise("not_needed")
    severity = F.when(k > 80, "critical").when(k > 50, "warn").when(k > 40, "error").when(k > 20, "info").otherwise("odd")
    system = F.when(k % 3 == 0, "parser_drift").when(k % 3 == 1, "load_monitoring").otherwise("other")
    shapes = {
        "view": ("refresh", F.format_string(_REFRESH, n, profile, state, iso(), iso(took), took, k, stage, iso(), iso(k), skip)),
        "click": ("scheduler", F.format_string(_SCHEDULER, profile, n, F.floor(n / 20), state, iso(took), system, iso(), iso(took), n, severity, iso())),
        "purchase": ("parser_drift", F.format_string(_ALERT, system, n, severity, iso(), iso())),
        "error": ("load_monitoring", F.format_string(_REFRESH, n, profile, state, iso(), iso(k * 10), took, k, stage, iso(), iso(k), skip)),
        "signup": ("benchmark_pack", F.format_string(_BENCH, state, iso(), n, severity, k)),
    }
    domain, body = F.lit(None), F.lit(None)
    for kind, (name, document) in shapes.items():
        domain, body = F.when(F.col("event_type") == kind, name).otherwise(domain), F.when(F.col("event_type") == kind, document).otherwise(body)
    body = F.when(k == 13, '{"run":').when(k == 14, "[1, 2]").otherwise(body)
    folder = scratch(spark, "artifacts")
    e.select(domain.alias("domain"), body.alias("value")).where("domain is not null").write.partitionBy("domain").text(folder)
    return folder


def _artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, parsed once and written: what is picked from them reads them several times."""
    return cut(A.read(spark, _written(spark, sf_dir), lines=True), "zstd")


def _now() -> Column:
    return F.to_timestamp(F.lit(NOW))


def artifact_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each domain, and those that could not be read, by error."""
    rows = _artifacts(spark, sf_dir)
    return rows.groupBy("domain", F.coalesce("error", F.lit("none")).alias("error")).agg(F.count("*").alias("n"))


def artifact_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical alerts of all documents that hold some, once for each event id."""
    found = A.alerts(_artifacts(spark, sf_dir), _now())
    once = found.groupBy("event_id").agg(F.min(F.struct("path", *[c for c in found.columns if c not in ("event_id", "path")])).alias("a")).select("event_id", "a.*")
    return once.select(
        "event_id", "source_system", "source_payload_type", "source_run_id", "alert_id", "source_alert_type", "severity", F.unix_seconds("generated_at").alias("generated"), "summary",
        F.array_join("reason_codes", ",").alias("reasons"), F.size("operator_actions").cast("long").alias("n_actions"), "source_routing_key",
    )


def artifact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of service levels from all run documents."""
    rows = A.run_events(_artifacts(spark, sf_dir), _now())
    return rows.select("sli", F.unix_seconds("observed_at").alias("observed"), "passed", "profile_name")


def stage_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations of each profile's latest run against the nearest-rank median of its successful runs before."""
    rows = cut(A.load_metrics(A.read(spark, _written(spark, sf_dir), lines=True)).where("at is not null"), "zstd")  # read by each step below
    latest = rows.groupBy("profile_name").agg(F.max(F.struct("at", "run_id")).alias("m")).select("profile_name", F.col("m.at").alias("last_at"), F.col("m.run_id").alias("last_run"))
    both = rows.join(latest, "profile_name")
    subject = both.where("run_id = last_run and at = last_at").select("profile_name", "metric", "run_id", "value", "unavailable")
    past = both.where("(at < last_at or (at = last_at and run_id < last_run)) and status = 'succeeded'")
    base = order_statistics(past, ["profile_name", "metric"], "value", {"baseline": nearest_rank(0.5)}).select("profile_name", "metric", F.col("n").alias("history"), "baseline")
    found = subject.join(base, ["profile_name", "metric"], "left")
    severity, reason = monitor.load_severity(F.lit("duration"), F.col("value"), F.col("baseline"), F.col("history"), unavailable=F.col("unavailable"))
    return found.select("profile_name", "metric", "run_id", "value", "baseline", F.coalesce("history", F.lit(0)).alias("history"), severity.alias("severity"), reason.alias("reason"))


QUERIES = {f.__name__: f for f in (artifact_errors, artifact_alerts, artifact_events, stage_signals)}


def _quoted(document: str, *values: str) -> str:
    return f"printf('{document}', {', '.join(values)})"


def _iso(later: str = "0") -> str:
    return f"strftime(to_timestamp(epoch(date_trunc('second', ts)) + {later}) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ')"


_DOCS = f"""e as (
  select *, cast(json_extract_string(props, '$.k') as bigint) as k, epoch(date_trunc('second', ts)) as sec from events),
v as (
  select *, {_PROFILES}[event_id % 4 + 1] as profile, case when k % 10 = 0 then 'cancelled' when k % 7 = 0 then 'failed' else 'succeeded' end as state, k * 60 as took, case when k % 5 = 0 then 'failed' else 'succeeded' end as stage,
         case when k > 80 then 'critical' when k > 50 then 'warn' when k > 40 then 'error' when k > 20 then 'info' else 'odd' end as severity,
         case k % 3 when 0 then 'parser_drift' when 1 then 'load_monitoring' else 'other' end as system,
         case event_type when 'view' then 'refresh' when 'click' then 'scheduler' when 'purchase' then 'parser_drift' when 'error' then 'load_monitoring' when 'signup' then 'benchmark_pack' end as domain,
         case when k = 13 then 'bad_json' when k = 14 then 'not_object' else 'none' end as error from e),
d as (select * from v where domain is not null and error = 'none')"""

_SQL_ALERT_ID = "'evt_' || substr(sha256(source_system || '|' || alert_id || '|' || sha), 1, 20)"

SQL = {
    "artifact_errors": f"with {_DOCS} select domain, error, count(*) as n from v where domain is not null group by all",
    "artifact_alerts": f"""with {_DOCS},
t as (
  select *, case event_type when 'click' then {_quoted(_SCHEDULER, "profile", "event_id", "event_id // 20", "state", _iso("took"), "system", _iso(), _iso("took"), "event_id", "severity", _iso())}
    when 'purchase' then {_quoted(_ALERT, "system", "event_id", "severity", _iso(), _iso())} when 'signup' then {_quoted(_BENCH, "state", _iso(), "event_id", "severity", "k")} end as body from d),
s as (select *, sha256(body) as sha from t),
a as (
  select sha, system as source_system, system || '_alert_payload_v1' as source_payload_type, cast(null as varchar) as source_run_id, 'a' || event_id as alert_id, system as source_alert_type,
         case when severity = 'error' then 'critical' else severity end as severity, cast(sec as bigint) as generated, system || ' ' || case when severity = 'error' then 'critical' else severity end || ' alert' as summary, 'slow,z_code' as reasons, 1 as n_actions
  from s where event_type = 'purchase' and system <> 'other' and (severity in ('critical', 'warn', 'info') or (severity = 'error' and system = 'parser_drift'))
  union all
  select sha, 'scheduler', 'scheduler_payload_v1', 's' || event_id, 'i' || event_id, 'scheduler', severity, cast(sec as bigint), 'scheduler incident', array_to_string(list_sort([system, 'z_code']), ','), 0
  from s where event_type = 'click' and severity in ('critical', 'warn', 'info')
  union all
  select sha, 'benchmark_pack', 'benchmark_pack_alert_payload_v1', 'b' || event_id, 'b' || event_id || '.alert.1', 'benchmark_pack', 'critical', cast(epoch(timestamp '{NOW}') as bigint), 'mix', '', 0 from s where event_type = 'signup'
  union all
  select sha, 'benchmark_pack', 'benchmark_pack_alert_payload_v1', null, 'benchmark_pack_alert_001', 'benchmark_pack', severity, cast(epoch(timestamp '{NOW}') as bigint), 'benchmark_pack alert', 'r' || k, 0
  from s where event_type = 'signup' and severity in ('critical', 'warn'))
select distinct {_SQL_ALERT_ID} as event_id, source_system, source_payload_type, source_run_id, alert_id, source_alert_type, severity, generated, summary, reasons, cast(n_actions as bigint) as n_actions, cast(null as varchar) as source_routing_key from a""",
    "artifact_events": f"""with {_DOCS},
lim as (select unnest({_PROFILES[:3]}) as profile, unnest([5400, 1800, 28800]) as most),
r as (select d.*, most from d join lim on lim.profile = d.profile where domain = 'refresh' and state <> 'cancelled'),
p as (
  select d.*, most, event_id // 20 as run from d join lim on lim.profile = d.profile where domain = 'scheduler' and state <> 'cancelled'
  and not exists (select 1 from r where r.profile = d.profile and r.event_id = d.event_id // 20)),
c as (
  select *, {_quoted(_SCHEDULER, "profile", "event_id", "event_id // 20", "state", _iso("took"), "system", _iso(), _iso("took"), "event_id", "severity", _iso())} as body from p),
f as (select * from (select *, row_number() over (partition by profile, run order by sha256(body)) as n from c) where n = 1),
timed as (select profile, state, sec + took as at_, took, most from r union all select profile, state, sec + took, took, most from f)
select 'refresh.success_ratio.' || profile as sli, cast(at_ as bigint) as observed, state = 'succeeded' as passed, profile as profile_name from timed
union all select 'refresh.latency_compliance.' || profile, cast(at_ as bigint), state = 'succeeded' and took <= most, profile from timed
union all select 'annual_refresh.required_stage_completion_ratio', cast(sec + took as bigint), false, profile from r where profile = 'annual_refresh'
union all select 'parser_drift.error_free_ratio', cast(sec as bigint), true, null from d where domain = 'parser_drift'
union all select 'parser_drift.artifact_coverage', cast(sec as bigint), false, null from d where domain = 'parser_drift'
union all select 'load_monitoring.critical_free_ratio', cast(sec + k * 10 as bigint), state = 'succeeded', null from d where domain = 'load_monitoring'
union all select 'load_monitoring.timeliness', cast(sec + k * 10 as bigint), state = 'succeeded' and k * 10 <= 600, null from d where domain = 'load_monitoring'
union all select 'benchmark.generation_success_ratio', cast(sec as bigint), state = 'succeeded', null from d where domain = 'benchmark_pack'""",
    "stage_signals": f"""with {_DOCS},
runs as (
  select 'r' || event_id as run_id, profile as profile_name, state as status, sec + case event_type when 'view' then took else k * 10 end as at_, took, k from d where event_type in ('view', 'error') and state <> 'cancelled'),
m as (
  select run_id, profile_name, status, at_, unnest(['duration.total_seconds', 'duration.stage.ingest_context.seconds', 'duration.stage.score_pipeline.seconds', 'duration.stage.health_summary.seconds',
           'duration.stage.analysis_artifacts.seconds', 'duration.stage.build_context.seconds', 'duration.stage.investigation_artifacts.seconds']) as metric,
         unnest([cast(took as double), k, k, null, null, null, null]) as value, unnest([false, false, false, k % 2 = 0, false, false, false]) as gone from runs),
l as (select profile_name, max(at_) as last_at, max_by(run_id, (at_, run_id)) as last_run from runs group by all),
b as (
  select m.profile_name, metric, count(value) as history, quantile_disc(value, 0.5) as baseline from m join l on l.profile_name = m.profile_name
  where (at_ < last_at or (at_ = last_at and run_id < last_run)) and status = 'succeeded' group by all),
j as (
  select m.profile_name, m.metric, run_id, value, baseline, coalesce(history, 0) as history, gone, (value - baseline) / nullif(baseline, 0) as delta from m join l on l.profile_name = m.profile_name and m.run_id = l.last_run and m.at_ = l.last_at
  left join b on b.profile_name = m.profile_name and b.metric = m.metric),
g as (
  select *, case when gone then 'ignored_unavailable_profile' when value is null then 'ignored_missing_subject_value' when history < 3 then 'ignored_insufficient_history' when coalesce(baseline, 0) = 0 then 'ignored_invalid_baseline' end as ign,
         case when delta >= 1 then 'critical' when delta >= 0.5 then 'warn' else 'ok' end as sev from j)
select profile_name, metric, run_id, value, baseline, history, case when ign is not null then 'ok' else sev end as severity,
       coalesce(ign, case when sev = 'ok' then 'ok_within_threshold' else sev || '_relative_delta' end) as reason from g""",
}
