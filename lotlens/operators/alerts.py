"""Alerts: one schema for several payload shapes, routing with precedence, and escalations that are due."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotlens.functions.text import stable_id

SEVERITIES = ["info", "warn", "critical"]


def canonical(df: DataFrame, system: str, alert_id: Column, kind: Column, severity: Column, reasons: Column, at: Column) -> DataFrame:
    """One schema for alerts: event_id, system, alert_id, alert_type, severity (error becomes critical), sorted reasons, at."""
    level = F.when(severity == "error", "critical").otherwise(severity)
    codes = F.array_join(F.array_sort(F.array_distinct(F.array_compact(reasons))), ",")
    out = df.select(F.lit(system).alias("system"), alert_id.cast("string").alias("alert_id"), kind.alias("alert_type"), level.alias("severity"), codes.alias("reasons"), at.alias("at"))
    body = F.sha2(F.concat_ws("|", "alert_type", "severity", "reasons"), 256)
    return out.withColumn("event_id", stable_id("evt_", F.col("system"), F.col("alert_id"), body))


def fan_out(alerts: DataFrame, routes: DataFrame, sent: DataFrame) -> DataFrame:
    """event_id, route, destination for each alert and destination of its first route; keys already sent are left out.

    routes: route_key, destinations, and alerts find theirs as type.severity, type.*, *.severity, *.* in this order.  The
    four tries are one join on an exploded key, and the best hit is picked by aggregation, so routes may be many.
    """
    keys = F.array(F.concat_ws(".", "alert_type", "severity"), F.concat_ws(".", "alert_type", F.lit("*")), F.concat_ws(".", F.lit("*"), "severity"), F.lit("*.*"))
    tries = alerts.select("event_id", F.posexplode(keys).alias("pos", "route_key"))
    best = tries.join(routes, "route_key").groupBy("event_id").agg(F.min(F.struct("pos", "route_key", "destinations")).alias("m"))
    pairs = best.select("event_id", F.col("m.route_key").alias("route"), F.explode("m.destinations").alias("destination"))
    return pairs.join(sent.select("event_id", "destination").distinct(), ["event_id", "destination"], "left_anti").select("event_id", "route", "destination")


def escalations_due(deliveries: DataFrame, fired: DataFrame, now: Column) -> DataFrame:
    """event_id, offset for each escalation step that is due and not fired, while its acknowledgement is still awaited.

    deliveries: event_id, first_at, ack_seconds (null: none wanted), offsets.  After the deadline nothing more is due.
    """
    age = F.unix_timestamp(now) - F.unix_timestamp("first_at")
    waiting = deliveries.where(F.col("ack_seconds").isNotNull() & F.col("first_at").isNotNull() & (age < F.col("ack_seconds")))
    due = waiting.select("event_id", F.explode(F.filter("offsets", lambda o: o <= age)).alias("offset"))
    return due.join(fired.select("event_id", "offset"), ["event_id", "offset"], "left_anti")
