"""Every query that has SQL gives the rows that DuckDB gives on the same files."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(entry.oracle_sql())

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, datetime.date) else v


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
