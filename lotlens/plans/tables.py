"""Queries that write tables in versions, streams and files, and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.plans.base import FACT, fact
from lotlens.runtime import scratch, table
from lotlens.sources.tables import KeyedTable
from lotlens.streaming import events as S


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(14,2)").alias("price"), F.col("o_orderstatus").alias("status"))


def table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders imported in three batches: most of them, then changed and new ones, then the second batch once more."""
    rows = _orders(spark, sf_dir)
    target = KeyedTable(spark, scratch(spark, "orders"), ["o_orderkey"], buckets=16)
    target.upsert(rows.where("status <> 'P'"), "first")
    later = rows.where("status = 'P' or o_orderkey % 3 = 0").withColumns({"price": (F.col("price") + 1).cast("decimal(14,2)"), "status": F.concat("status", F.lit("2"))})
    target.upsert(later, "second")
    version = target.upsert(later, "second")
    return target.read().withColumns({"version": F.lit(version.number), "inserted": F.lit(version.counts["inserted"]).cast("long"), "updated": F.lit(version.counts["updated"]).cast("long")})


def scoped_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the odd parcels are built anew without their years before 1996; other parcels keep theirs."""
    rows = fact(spark, sf_dir).select("parcel_id", "yr", "v")
    target = KeyedTable(spark, scratch(spark, "facts"), ["parcel_id", "yr"], ["parcel_id"], buckets=16)
    target.upsert(rows)
    scope = rows.where("parcel_id % 2 = 1").select("parcel_id")
    target.replace(scope, rows.where("parcel_id % 2 = 1 and yr >= 1996").withColumn("v", (F.col("v") + 1).cast(rows.schema["v"].dataType)))
    return target.read()


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events dropped as files in two runs of a stream, with late ones and repeats in the second, as closed windows.

    The first run takes the first half of the events' time; the second goes on from its checkpoint.
    """
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", (F.col("event_type") != "error").alias("ok"))
    root = scratch(spark, "stream")
    middle = rows.agg(F.percentile_approx(F.unix_seconds("ts"), 0.5)).first()[0]
    half = F.unix_seconds("ts") <= F.lit(middle or 0)
    target = KeyedTable(spark, f"{root}/windows", ["event_type", "start"], buckets=4)
    for part in (rows.where(half), rows.where(~half | (F.col("event_id") % 10 == 0))):
        part.coalesce(1).sortWithinPartitions("ts").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        windows = S.sli_windows(stream, ["event_type"], "ts", "ok", "event_id", window="1 day", late="1 day")
        S.into_table(windows, target, f"{root}/checkpoint").awaitTermination()
    # What is still open after the last batch is known from its watermark: a day before the latest event.
    return target.read().select("event_type", F.unix_seconds("start").alias("start"), "n_passed", "n")


def stream_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of orders dropped in two runs of a stream; the second run's files change rows of the first."""
    from lotlens.sources import imports

    rows = _orders(spark, sf_dir)
    root = scratch(spark, "import")
    target = KeyedTable(spark, f"{root}/table", ["document_number_raw"], buckets=4)

    def parse(session: SparkSession, paths: list[str]) -> DataFrame:
        return imports.import_sales(session, paths).select("document_number_raw", "import_status", "consideration")

    for part, more in ((rows.where("o_orderkey % 4 < 3"), 0), (rows.where("o_orderkey % 4 >= 2"), 5)):
        lines = part.select(F.lit("01/02/2003").alias("Sale Date"), (F.col("price") + more).cast("string").alias("Sale Price"), F.col("o_orderkey").cast("string").alias("Document Number"), F.when(F.col("status") != "P", F.col("o_custkey").cast("string")).alias("PIN"))
        lines.write.mode("append").option("header", True).csv(f"{root}/in")
        S.import_stream(spark, f"{root}/in", target, f"{root}/checkpoint", parse).awaitTermination()
    return target.read().select(F.col("document_number_raw").cast("long").alias("o_orderkey"), "import_status", F.col("consideration").cast("double").alias("price"))


QUERIES = {f.__name__: f for f in (table_upsert, scoped_replace, stream_windows, stream_import)}

_ORDERS = "o as (select o_orderkey, o_custkey, cast(o_totalprice as decimal(14,2)) as price, o_orderstatus as status from orders)"

SQL = {
    "table_upsert": f"""with {_ORDERS},
c as (select count(*) filter (where status = 'P') as inserted, count(*) filter (where status <> 'P' and o_orderkey % 3 = 0) as updated from o)
select o_orderkey, o_custkey, case when status = 'P' or o_orderkey % 3 = 0 then price + 1 else price end as price, case when status = 'P' or o_orderkey % 3 = 0 then status || '2' else status end as status,
       2 as version, inserted, updated from o, c""",
    "scoped_replace": f"with {FACT} select parcel_id, yr, case when parcel_id % 2 = 1 then v + 1 else v end as v from fact where parcel_id % 2 = 0 or yr >= 1996",
    "stream_import": f"""with {_ORDERS}
select o_orderkey, case when status = 'P' then 'rejected' else 'loaded' end as import_status, cast(case when o_orderkey % 4 >= 2 then price + 5 else price end as double) as price from o""",
    "stream_windows": """with e as (select event_id, ts, event_type, event_type <> 'error' as ok, date_trunc('day', ts) as day, epoch(date_trunc('second', ts)) as sec from events),
last as (select max(ts) as last_at from e)
select event_type, cast(epoch(day) as bigint) as start, count(*) filter (where ok) as n_passed, count(*) as n from e, last where day + interval 1 day <= last_at - interval 1 day group by all""",
}
