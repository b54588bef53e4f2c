from __future__ import annotations

from pyspark.sql import functions as F

from lotlens.sources import imports
from lotlens.sources.tables import KeyedTable
from lotlens.streaming.events import import_stream, into_table, sli_windows

SF = "/root/testdata/sf0.001"


def test_windows_equal_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    twice = events.unionByName(events).repartition(2)
    twice.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    rows = stream.withColumn("ok", F.col("event_type") != "error")
    out = sli_windows(rows, ["event_type"], "ts", "ok", "event_id", late="1 hour")
    query = out.writeStream.format("memory").queryName("windows").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    batch = events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count_if(F.col("event_type") != "error").alias("p"), F.count("*").alias("n"))
    closed = events.agg(F.max("ts") - F.expr("interval 1 hour")).first()[0]  # later windows are still open
    want = sorted(tuple(r) for r in batch.where(F.col("w.end") <= F.lit(closed)).select("event_type", "w.start", "p", "n").collect())
    assert len(want) > 500 and sorted(tuple(r) for r in spark.table("windows").collect()) == want


def test_dropped_files_are_imported_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    parse = lambda s, paths: imports.import_sales(s, paths)
    target = KeyedTable(spark, f"file://{tmp_path}/out", ["sha256", "row_number"], buckets=4)
    run = lambda: import_stream(spark, str(tmp_path / "in"), target, str(tmp_path / "check"), parse).awaitTermination()
    head = "Sale Date,Sale Price,PIN\n"
    (tmp_path / "in" / "a.csv").write_text(head + "1/2/2024,5,1\n1/2/2024,x,1\n")
    run()
    (tmp_path / "in" / "b.csv").write_text(head + "1/2/2024,6,2\n")
    (tmp_path / "in" / "again.csv").write_text(head + "1/2/2024,5,1\n1/2/2024,x,1\n")
    run()
    run()
    got = target.read()
    assert target.versions() == [1, 2] and sorted((r["import_status"], r["parcel_number_norm"]) for r in got.collect()) == [("loaded", "1"), ("loaded", "2"), ("rejected", "1")]


def test_a_stopped_stream_goes_on_and_drops_late_rows(spark, tmp_path):
    """Three runs over growing input: windows come once, closed, whatever was repeated; rows behind the watermark are dropped."""
    target = KeyedTable(spark, f"file://{tmp_path}/windows", ["g", "start"], buckets=2)
    schema = "id long, g string, at timestamp, ok boolean"

    def run(rows):
        spark.createDataFrame(rows, "id long, g string, at string, ok boolean").withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        into_table(sli_windows(stream, ["g"], "at", "ok", "id", window="1 hour", late="1 hour"), target, str(tmp_path / "check")).awaitTermination()

    run([(1, "a", "2024-01-01 00:10:00", True), (2, "a", "2024-01-01 00:20:00", False), (1, "a", "2024-01-01 00:10:00", True), (3, "a", "2024-01-01 03:30:00", True)])
    assert [(r.start.hour, r.n_passed, r.n) for r in target.read().collect()] == [(0, 1, 2)]
    run([(3, "a", "2024-01-01 03:30:00", True), (4, "a", "2024-01-01 00:30:00", True), (5, "a", "2024-01-01 03:40:00", True)])  # 4 comes too late
    assert [(r.start.hour, r.n) for r in target.read().collect()] == [(0, 2)]
    run([(6, "a", "2024-01-01 06:00:00", True)])
    assert sorted((r.start.hour, r.n) for r in target.read().collect()) == [(0, 2), (3, 2)]
