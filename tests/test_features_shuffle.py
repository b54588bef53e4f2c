from __future__ import annotations

import re

from lotlens.plans import scoring

SF = "/root/testdata/sf0.001"


def test_lines_are_dealt_by_part_once_and_structs_are_not_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr(scoring, "cut", lambda df, *more: written.append(df) or df)
    scoring.feature_rows(spark, SF)
    (base,) = written
    assert not [c for c, kind in base.dtypes if kind.startswith("struct")]
    plan = base._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert all(d.startswith("parcel_id#") and "yr" not in d for d in dealt) and 1 <= len(dealt) <= 2, dealt
