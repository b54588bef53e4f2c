"""Streams of run events and of file drops: windowed service levels and idempotent imports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotlens.sources.tables import KeyedTable


def sli_windows(events: DataFrame, by: list[str], at: str, passed: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Passed and total events for each group and window of a stream; an event key counts once within the lateness.

    State holds one row for each open window and group and one key for each event of the last ``late``; both are dropped
    as the watermark moves on.
    """
    once = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark([key])
    windows = once.groupBy(F.window(at, window).alias("w"), *by).agg(F.count_if(F.col(passed)).alias("n_passed"), F.count("*").alias("n"))
    return windows.select(*by, F.col("w.start").alias("start"), "n_passed", "n")


def into_table(rows: DataFrame, target: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Add a stream's finished rows to a keyed table, each batch as one version.

    A version is marked with its batch, so a batch that is repeated after a failure is not added twice, and a query that
    is stopped goes on from its checkpoint.  Takes what is there, then ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            target.upsert(batch, token=f"batch {number}")

    return rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def import_stream(spark: SparkSession, folder: str, target: KeyedTable, checkpoint: str, parse: Callable[[SparkSession, list[str]], DataFrame], pattern: str = "*.csv") -> StreamingQuery:
    """Files dropped into a folder are imported once each; a row takes the place of that with its key, from whichever file.

    Only the files of a batch are parsed, and only the buckets of their keys are written again.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).load(folder)

    def write(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]  # names of the files of one batch
        if paths:
            target.upsert(parse(batch.sparkSession, paths), token=f"batch {number}")

    return files.select("path").writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
