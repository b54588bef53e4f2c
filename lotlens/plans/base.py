"""The provided tables read as parcel tables, for queries and for their SQL.

fact: part-years from lineitem; sale: orders with their first lineitem; FACT, SALE: the same as SQL common tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.operators.pick import largest_row
from lotlens.runtime import table


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(parcel_id, yr, muni, cls, v)"""
    line = table(spark, sf_dir, "lineitem").select("l_partkey", F.year("l_shipdate").alias("yr"), F.col("l_extendedprice").cast("decimal(14,2)").alias("price"))
    sums = line.groupBy("l_partkey", "yr").agg(F.sum("price").alias("v"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("muni"), F.col("p_type").alias("cls"))
    return sums.join(part, "l_partkey").select(F.col("l_partkey").alias("parcel_id"), "yr", "muni", "cls", "v")


def sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(txn, parcel_id, yr, price, st, seg, sold)"""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    line = line.withColumns({"a": -F.col("l_linenumber"), "b": -F.col("l_partkey")})
    first = largest_row(line, ["l_orderkey"], ["a", "b"], ["l_partkey"])
    orders = table(spark, sf_dir, "orders")
    both = orders.join(first, F.col("o_orderkey") == F.col("l_orderkey"))
    return both.select(
        F.col("o_orderkey").alias("txn"), F.col("l_partkey").alias("parcel_id"), F.year("o_orderdate").alias("yr"), F.col("o_totalprice").cast("decimal(14,2)").alias("price"),
        F.col("o_orderstatus").alias("st"), F.col("o_orderpriority").alias("seg"), F.col("o_orderdate").alias("sold"),
    )


FACT = """fact as (
  select l_partkey as parcel_id, year(l_shipdate) as yr, p_brand as muni, p_type as cls, sum(cast(l_extendedprice as decimal(14,2))) as v
  from lineitem join part on p_partkey = l_partkey group by all)"""

SALE = """first_line as (
  select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) as n from lineitem),
sale as (
  select o_orderkey as txn, l_partkey as parcel_id, year(o_orderdate) as yr, cast(o_totalprice as decimal(14,2)) as price, o_orderstatus as st, o_orderpriority as seg, o_orderdate as sold
  from orders join first_line on o_orderkey = l_orderkey and n = 1)"""
