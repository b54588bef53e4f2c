from __future__ import annotations

from lotlens.plans import artifacts
from lotlens.sources import artifacts as A

SF = "/root/testdata/sf0.001"


def test_documents_are_parsed_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(artifacts, "cut", lambda df, *more: written.append(df) or df, raising=False)
    artifacts._artifacts(spark, SF)
    assert len(written) == 1 and "payload" in written[0].columns


def test_stages_are_parsed_before_a_run_is_split_into_metrics(spark):
    docs = A.read(spark, artifacts._written(spark, SF), lines=True)
    plan = A.load_metrics(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "stages" in plan[plan.index("Generate explode") :]
