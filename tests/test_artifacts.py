"""Alerts, run events and load metrics of JSON files of many shapes, good and bad."""

from __future__ import annotations

import datetime
import json

import pytest
from lotlens.sources import artifacts as A
from pyspark.sql import functions as F

NOW = datetime.datetime(2024, 5, 1)


@pytest.fixture()
def read(spark, tmp_path):
    def of(**documents):
        for domain, own in documents.items():
            (tmp_path / f"domain={domain}").mkdir()
            for k, doc in enumerate(own):
                (tmp_path / f"domain={domain}" / f"{k}.json").write_text(doc if isinstance(doc, str) else json.dumps(doc))
        return A.read(spark, str(tmp_path))

    return of


def now():
    return F.lit(NOW)


def test_bad_files_are_rows(read):
    got = {(r.domain, r.path[-6:], r.error, r.payload is None) for r in read(x=['{"a": 1}', "{broken", "[1]", '"text"', "", "null"]).collect()}
    assert got == {("x", "0.json", None, False), ("x", "1.json", "bad_json", True), ("x", "2.json", "not_object", True), ("x", "3.json", "not_object", True), ("x", "5.json", "not_object", True)}


def test_alerts_of_three_shapes(read):
    drift = {"alert": {"alert_type": "parser_drift", "alert_id": "d1", "severity": "error", "generated_at": "2024-01-02T03:04:05+01:00", "reason_codes": ["b", " a ", "b", 3, ""], "routing_key": "k"}, "run": {"run_id": "r1"}, "operator_actions": [{"x": 1}, "no"]}
    load = {"alert": {"alert_type": "load_monitoring", "alert_id": "l1", "severity": "warn", "generated_at": "2024-01-02T03:04:05", "subject_run_id": "s", "summary": "slow"}}
    bench = {"alerts": [{"severity": "warn"}, {"severity": "info", "alert_id": "no"}, {"severity": "critical", "alert_id": "run7.alert.2", "alert_type": "mix"}, 5]}
    incident = {"incident": {"incident_id": "i1", "severity": "critical"}, "result": {"failure_code": "z", "failure_class": "a", "recommended_operator_action_summary": "wait"}, "scheduler_run": {"scheduler_run_id": "s9"}}
    others = [{"alert": {"alert_type": "parser_drift", "alert_id": 7, "severity": "warn"}}, {"alert": {"alert_type": "load_monitoring", "alert_id": "x", "severity": "error"}}, {"alert": {"alert_type": "else", "alert_id": "x", "severity": "warn"}}, {"alert": []}, "{"]
    found = {r.alert_id: r for r in A.alerts(read(any=[drift, load, bench, incident, *others]), now()).collect()}
    assert set(found) == {"d1", "l1", "benchmark_pack_alert_000", "run7.alert.2", "i1"}
    d = found["d1"]
    assert (d.severity, d.reason_codes, d.operator_actions, d.source_run_id, d.source_routing_key, d.generated_at) == ("critical", ["a", "b"], ['{"x":1}'], "r1", "k", datetime.datetime(2024, 1, 2, 2, 4, 5))
    assert d.summary == "parser_drift critical alert" and d.event_id.startswith("evt_") and len(d.event_id) == 24
    assert (found["l1"].generated_at, found["l1"].source_run_id, found["l1"].summary) == (NOW, "s", "slow")  # no offset: the time is unknown
    assert (found["run7.alert.2"].source_run_id, found["run7.alert.2"].source_alert_type, found["benchmark_pack_alert_000"].source_alert_type) == ("run7", "mix", "benchmark_pack")
    i = found["i1"]
    assert (i.source_run_id, i.summary, i.reason_codes) == ("s9", "wait", ["a", "z"]) and json.loads(i.operator_actions[0]) == {"action_id": "follow_scheduler_recommendation", "message": "wait", "artifact_paths": []}


def run(profile, status, minutes=None, run_id="r", **more):
    at = {} if minutes is None else {"started_at": "2024-01-01T00:00:00Z", "finished_at": f"2024-01-01T{minutes // 60:02d}:{minutes % 60:02d}:00Z"}
    return {"run": {"profile_name": profile, "status": status, "run_id": run_id, **at}, **more}


def planned(profile, status, run_id, own="s", minutes=10):
    times = {"started_at_utc": "2024-01-01T00:00:00Z", "finished_at_utc": f"2024-01-01T00:{minutes}:00Z"}
    return {"scheduler_run": {"profile_name": profile, "refresh_run_id": run_id, "scheduler_run_id": own}, "result": {"status": status}, "attempts": [times, {"started_at_utc": "x"}, 3]}


def test_events_of_all_kinds_of_runs(read):
    rows = read(
        refresh=[
            run("daily_refresh", "succeeded", 90), run("daily_refresh", "succeeded", 91, "r2"), run("daily_refresh", "cancelled", 1, "r3"), run("nightly", "succeeded", 1), run("analysis_only", "failed", 5),
            run("annual_refresh", "succeeded", 60, stages=[{"status": "succeeded"}, {"status": "succeeded"}]), run("annual_refresh", "succeeded", 60, "a2", stages=[{"status": "succeeded"}, {"status": "blocked"}]), run("annual_refresh", "succeeded", 60, "a3", stages=[]),
        ],
        scheduler=[planned("daily_refresh", "succeeded", "r"), planned("daily_refresh", "failed", "q"), planned("daily_refresh", "succeeded", "q", "s2"), planned("daily_refresh", "cancelled", "z"), planned("analysis_only", "succeeded", None, "own", 31)],
        parser_drift=[{"run": {"run_type": "parser_drift_diff", "status": "succeeded"}, "alerts": [{"severity": "warn"}], "baseline": {"artifact_path": "a"}, "current": {"artifact_path": "b"}}, {"run": {"run_type": "parser_drift_diff", "status": "succeeded"}, "alerts": [{"severity": "error"}]}, {"run": {"run_type": "snapshot"}}],
        load_monitoring=[run(None, "succeeded", 10, summary={"overall_severity": "warn"}), run(None, "succeeded", 11, summary={"overall_severity": "critical"})],
        annual_signoff=[{"run": {"status": "approved"}}, {"run": {"status": "rejected"}}, {"run": {"status": "draft"}}],
        benchmark_pack=[{"run": {"status": "succeeded"}}, {"run": {"status": "failed"}}, "{"],
    )
    got = {}
    for r in A.run_events(rows, now()).collect():
        got.setdefault(r.sli, []).append(r.passed)
    assert {k: sorted(v) for k, v in got.items()} == {
        "refresh.success_ratio.daily_refresh": [False, True, True], "refresh.latency_compliance.daily_refresh": [False, False, True],
        "refresh.success_ratio.analysis_only": [False, True], "refresh.latency_compliance.analysis_only": [False, False],
        "refresh.success_ratio.annual_refresh": [True] * 3, "refresh.latency_compliance.annual_refresh": [True] * 3, "annual_refresh.required_stage_completion_ratio": [False, False, True],
        "parser_drift.error_free_ratio": [False, True], "parser_drift.artifact_coverage": [False, True], "load_monitoring.critical_free_ratio": [False, True], "load_monitoring.timeliness": [False, True],
        "annual_refresh.signoff_success_ratio": [False, True], "benchmark.generation_success_ratio": [False, True],
    }


def test_stage_durations(read):
    doc = run("daily_refresh", "succeeded", 5, summary={"duration_seconds_total": 300}, stages=[
        {"stage_id": "ingest_context", "status": "succeeded", "duration_seconds": 4}, {"stage_id": "ingest_context", "status": "succeeded", "duration_seconds": 5},
        {"stage_id": "build_context", "started_at": "2024-01-01T00:00:10Z", "finished_at": "2024-01-01T00:00:12.500Z"}, {"stage_id": "score_pipeline", "started_at": "2024-01-01T00:00:10Z", "finished_at": "2024-01-01T00:00:00Z"},
        {"stage_id": "health_summary", "status": "skipped"}, {"stage_id": "analysis_artifacts", "status": "skipped"}, {"stage_id": "investigation_artifacts", "duration_seconds": "7"}, 9,
    ], diagnostics={"skip_reasons": [{"stage_id": "health_summary", "reason": "profile_skip:daily"}, {"stage_id": "analysis_artifacts", "reason": "failed_before"}]})
    got = {r.metric.removeprefix("duration.").removeprefix("stage."): (r.value, r.unavailable) for r in A.load_metrics(read(refresh=[doc, run("x", "cancelled"), {"run": {"status": "failed"}}])).collect()}
    assert got == {
        "total_seconds": (300.0, False), "ingest_context.seconds": (5.0, False), "build_context.seconds": (2.5, False), "score_pipeline.seconds": (0.0, False), "health_summary.seconds": (None, True),
        "analysis_artifacts.seconds": (None, False), "investigation_artifacts.seconds": (None, False),
    }
