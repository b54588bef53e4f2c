"""Lines of an order that share number and price follow each other as in their table, as in the SQL read by one thread."""

from __future__ import annotations

import duckdb
from lotlens.plans import taxes


def test_lines_that_tie_keep_the_order_of_their_table(spark, tmp_path):
    con = duckdb.connect(config={"threads": 1})
    con.execute("create table orders as select i as o_orderkey, i as o_custkey, 'O' as o_orderstatus, 7.5::double as o_totalprice, timestamp '1999-01-01' as o_orderdate, '' as o_orderpriority from range(40) r(i)")
    con.execute("create table lineitem as select (i * 7 % 40)::bigint as l_orderkey, 1 as l_linenumber, (50 - i // 40)::double as l_quantity, 5.0::double as l_extendedprice, case when i % 2 = 0 then 'O' else 'F' end as l_linestatus, 'R' as l_returnflag, timestamp '1999-02-01' as l_shipdate from range(240) r(i)")
    for name in ("orders", "lineitem"):
        con.execute(f"copy {name} to '{tmp_path}/{name}.parquet' (row_group_size 64)")
    cols = "page_id tax_value_rows tax_rate_rows special_charge_rows".split()
    got = sorted(tuple(r) for r in taxes.tax_detail_pages(spark, str(tmp_path)).select(*cols).collect())
    assert got[1][2] == ";".join(f"Rate 1={q}" for q in (50, 49, 48, 47, 46, 45))
    assert got == con.execute(f"select {', '.join(cols)} from ({taxes.SQL['tax_detail_pages']}) order by page_id").fetchall()
