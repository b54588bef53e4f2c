"""Parcel dossiers in batch: a timeline of all sources, section summaries, and the investigation set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotlens.operators.pick import best_row

#: The order of event types on one day.
PRECEDENCE = ["score", "appeal", "permit", "sale", "assessment"]


def event(df: DataFrame, kind: str, parcel: Column, row_id: Column, day: Column, year: Column, amount: Column) -> DataFrame:
    """Rows of one source as events; without a date the year stands for 1 January, for scores for 31 December."""
    month, last = (12, 31) if kind == "score" else (1, 1)
    fallback = F.make_date(year, F.lit(month), F.lit(last))
    return df.select(parcel.alias("parcel_id"), F.lit(kind).alias("event_type"), row_id.cast("long").alias("row_id"), F.coalesce(day, fallback).alias("event_date"), year.cast("int").alias("event_year"), amount.cast("double").alias("amount"))


def timeline(*events: DataFrame) -> DataFrame:
    """All events of all parcels with their position: newest first, undated last, then type precedence and id."""
    both = reduce(DataFrame.unionByName, events)
    rank = F.array_position(F.array(*[F.lit(p) for p in PRECEDENCE]), F.col("event_type"))
    at = Window.partitionBy("parcel_id").orderBy(F.desc_nulls_last("event_date"), rank, "row_id", F.desc("amount"))
    return both.withColumn("position", F.row_number().over(at))


def in_years(year: Column, dates: list[Column], years: list[int]) -> Column:
    """If the row's own year is set it alone decides, else any of its dates."""
    return F.when(year.isNotNull(), year.isin(years)).otherwise(F.coalesce(F.exists(F.array(*dates), lambda d: F.year(d).isin(years)), F.lit(False)))


def section_summary(events: DataFrame) -> DataFrame:
    """For each parcel and section: rows, first and last year, dated rows, sum of positive amounts."""
    return events.groupBy("parcel_id", "event_type").agg(
        F.count("*").alias("n"), F.min("event_year").alias("first_year"), F.max("event_year").alias("last_year"), F.count("event_date").alias("n_dated"),
        F.round(F.sum(F.when(F.col("amount") > 0, F.col("amount"))), 2).alias("amount"),
    )


def investigation_set(queue: DataFrame, summaries: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """Queue rows with the number of their dossier sections and events, and with their latest review."""
    counts = summaries.groupBy(key).agg(F.count("*").alias("n_sections"), F.sum("n").alias("n_events"))
    return queue.join(counts, key, "left").join(reviews, key, "left")


def peer_context(features: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Feature rows with the fact of their parcel-year where there is one; fact columns that features have too are prefixed."""
    renamed = facts.select(*keys, *[F.col(c).alias(f"fact_{c}" if c in features.columns else c) for c in facts.columns if c not in keys])
    return features.join(renamed, keys, "left")


def assessment_history(assessments: DataFrame, facts: DataFrame, keys: tuple[str, str] = ("parcel_id", "year"), row_id: str = "assessment_id") -> DataFrame:
    """Assessments, and facts of the years that a parcel has no assessment of, with a null id; newest year first, unknown years last.

    facts have the columns of the assessments but the id.
    """
    parcel, year = keys
    known = assessments.where(F.col(year).isNotNull()).select(parcel, year).distinct()
    return assessments.unionByName(facts.join(known, [parcel, year], "left_anti"), allowMissingColumns=True)


def matched_sales(matches: DataFrame, sales: DataFrame, exclusions: DataFrame, txn: str = "txn", row_id: str = "match_id") -> DataFrame:
    """One row for each parcel and sale that a match names, by the best of its matches, with the sorted codes of its active exclusions.

    matches: parcel_id, txn, match_id, is_primary, confidence, match_rank and others; sales: txn and others; exclusions:
    txn, exclusion_code, is_active.
    """
    order = [F.desc(F.coalesce("is_primary", F.lit(False))), F.desc_nulls_last("confidence"), F.asc_nulls_last("match_rank"), F.asc(row_id)]
    best = best_row(matches.repartition(txn), ["parcel_id", txn], order)  # dealt once for this and for the joins
    codes = exclusions.where("is_active").groupBy(txn).agg(F.array_sort(F.collect_set("exclusion_code")).alias("exclusion_codes"))
    rows = best.join(sales, txn).join(codes, txn, "left")
    return rows.withColumn("exclusion_codes", F.coalesce("exclusion_codes", F.array().cast("array<string>")))


def documents(header: DataFrame, sections: dict[str, tuple[DataFrame, list[Column]]], most: int = 100, parcel: str = "parcel_id") -> DataFrame:
    """One row for each parcel of ``header``: its columns, and for each section an array of its first ``most`` rows and ``n_<section>``, all of them.

    sections: rows with the parcel and any other columns, and their order, which should end in a unique column.  Rows
    beyond ``most`` are dropped by each task before the shuffle, so a parcel with very many rows gathers only those that
    are shown.  Header and sections are one union that is grouped where its parts lie, by parcel; a parcel without rows of
    a section has an empty array and 0, and a row of a section that has no parcel goes to headers that have none.
    """
    head = F.struct(*[F.col(f"`{c}`") for c in header.columns])
    parts = [header.repartition(parcel).select(F.col(parcel).alias("__parcel"), head.alias("__head"))]
    for name, (df, order) in sections.items():
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != parcel])
        place = F.row_number().over(Window.partitionBy(parcel).orderBy(*order))
        first = df.withColumn("__place", place).where(F.col("__place") <= most)
        parts.append(first.select(F.col(parcel).alias("__parcel"), F.struct(F.col("__place").alias("place"), row.alias("row")).alias(f"__rows_{name}")))
        parts.append(df.groupBy(F.col(parcel).alias("__parcel")).agg(F.count("*").alias(f"__n_{name}")))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    lists = [F.transform(F.array_sort(F.collect_list(f"__rows_{name}")), lambda x: x["row"]).alias(f"__rows_{name}") for name in sections]
    grouped = union.groupBy("__parcel").agg(F.collect_list("__head").alias("__head"), *lists, *[F.sum(f"__n_{name}").alias(f"__n_{name}") for name in sections])
    both = grouped.withColumn("__head", F.explode("__head"))
    out = [F.col(f"__head.`{c}`") for c in header.columns]
    for name in sections:
        rows = F.col(f"__rows_{name}")
        out += [rows.alias(name), F.coalesce(f"__n_{name}", F.lit(0)).alias(f"n_{name}")]
    return both.select(*out)


def fact_header(parcels: DataFrame, facts: DataFrame, fields: list[str], parcel: str = "parcel_id", year: str = "year") -> DataFrame:
    """parcels with ``fields`` of their newest fact, null without one."""
    newest = facts.groupBy(parcel).agg(F.max_by(F.struct(*fields), year).alias("__newest"))
    return parcels.join(newest, parcel, "left").select(*parcels.columns, *[F.col("__newest").getField(f).alias(f) for f in fields])
