from __future__ import annotations

import os

from lotlens.plans import records
from lotlens.sources import imports


def test_csv_files_hold_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(records, "CSV_ROWS", 2)
    folder = records._csv_folder(spark, spark.range(5).selectExpr("cast(id as string) as PIN").coalesce(1), "t")
    names = [n for n in os.listdir(folder.removeprefix("file://")) if n.startswith("part-")]
    assert len(names) == 3
    rows = imports.csv_rows(spark, folder).collect()
    assert sorted((r["row_number"], r["cells"]["PIN"]) for r in rows) == [(1, "0"), (1, "2"), (1, "4"), (2, "1"), (2, "3")]


def test_binding_takes_the_first_alias_that_a_row_has(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿PIN,Sale Date,Conveyance Date,Legal\r\n1,a,b,"x\r\ny"\r\n\r\n2\r\n3,,z\r\n'.encode())
    got = imports.bind(spark, str(tmp_path / "a.csv"), {"day": ["Conveyance Date", "Sale Date"], "pin": ["PIN"], "legal": ["Legal"], "none": ["Other"]}, False).orderBy("row_number").collect()
    assert [(r["row_number"], r["n_cells"], r["pin_raw"], r["day_raw"], r["legal_raw"], r["none_raw"]) for r in got] == [(1, 4, "1", "b", "x\r\ny", None), (2, 1, "2", None, None, None), (3, 3, "3", "z", None, None)]
    assert {(r["file_error"], r["n_names"]) for r in got} == {(None, 4)}
