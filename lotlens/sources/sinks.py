"""Results as files that others read: the review queue and metric series as CSV, in partitions that a rerun replaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.operators.review import formula_safe

# The columns of the two files, in their order.
QUEUE_COLUMNS = [
    "queue_rank", "score_id", "run_id", "feature_run_id", "parcel_id", "year", "score_value", "risk_band", "requires_review", "review_status", "review_disposition", "review_updated_at",
    "reason_code_count", "primary_reason_code", "primary_reason_weight", "municipality_name", "valuation_classification", "dossier_parcel_id", "dossier_year", "dossier_feature_version", "dossier_ruleset_version",
]
SERIES_COLUMNS = ["metric_id", "domain", "environment", "profile_name", "window", "observed_at_utc", "value", "numerator", "denominator"]

#: Any text comes back as it was: quotes are doubled, white space and line ends are kept, '' is written as ''.
_CSV = {"header": "true", "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": "", "encoding": "UTF-8", "quoteAll": "true", "lineSep": "\n"}


def _write(rows: DataFrame, columns: list[str], folder: str, part: str) -> None:
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    named = formula_safe(rows.select(*columns, F.col(part).alias(f"of_{part}")))
    named.write.mode("overwrite").options(**_CSV, partitionOverwriteMode="dynamic").partitionBy(f"of_{part}").csv(folder)


def _read(spark: SparkSession, columns: list[str], folder: str) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).options(**_CSV, nullValue="\0", recursiveFileLookup="true").csv(folder)


def write_queue(rows: DataFrame, folder: str) -> None:
    """A review queue with QUEUE_COLUMNS as CSV for a spreadsheet; other columns are not written.

    Null is an empty text, booleans are true and false, and text that would start a formula gets a quote before it.
    Each run_id has a folder of its own; writing it again replaces its files and leaves those of other runs.
    """
    _write(rows, QUEUE_COLUMNS, folder, "run_id")


def read_queue(spark: SparkSession, folder: str) -> DataFrame:
    """What write_queue wrote, all columns as text."""
    return _read(spark, QUEUE_COLUMNS, folder)


def write_series(rows: DataFrame, folder: str, part: str = "observed_at_utc") -> None:
    """Metric rows with SERIES_COLUMNS as CSV, in a folder for each value of ``part``, which a rerun replaces alone."""
    _write(rows, SERIES_COLUMNS, folder, part)


def read_series(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, SERIES_COLUMNS, folder)
