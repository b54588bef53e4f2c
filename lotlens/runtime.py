"""Session helpers: the shared folder for cut lineage, table reading, and size checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as ``spark.checkpoint.dir`` names it.

    Only where that is unset is another taken: in local mode a folder under /tmp (one machine, as in tests).  On a
    cluster there is no folder that is surely shared, so an unset one is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        return "file:///tmp/checkpoints"
    raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, below one folder for each application, which may go when the application has ended."""
    return f"{shared_folder(spark)}/lotlens-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application has written below its scratch folder; results that read from there must be stored before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/lotlens-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, compression: str = "none") -> DataFrame:
    """Write df to the shared folder and read it from there: later steps neither recompute nor lose it with an executor.

    A written table also has a known size.  Estimates of a checkpoint are those of its plan, and multiply with every join
    of an iterative algorithm.
    """
    path = scratch(df.sparkSession, "cut")
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
