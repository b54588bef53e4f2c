"""Parcel-year facts: best source records, roll-ups of permits, appeals and payments, and their assembly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotlens.operators.pick import best_row


def year_universe(*sources: DataFrame) -> DataFrame:
    """Distinct (parcel, year) of all sources."""
    return reduce(DataFrame.unionByName, [s.distinct() for s in sources]).distinct()


def best_assessment(df: DataFrame, keys: list[str], source: str, order: list[str]) -> DataFrame:
    """The best assessment for each key: detail before summary before others, then ``order`` descending, nulls last."""
    rank = F.when(F.col(source) == "detail", 3).when(F.col(source) == "summary", 2).otherwise(1)
    usable = df.where(~F.col(source).eqNullSafe("valuation_breakout"))
    return best_row(usable, keys, [rank.desc(), *[F.desc_nulls_last(c) for c in order]])


def _known(amount: Column, name: str) -> list[Column]:
    """Count of known amounts and their sum; the sum is null if none is known."""
    return [F.count(amount).alias(f"{name}_known"), F.sum(amount).alias(f"{name}_sum")]


def permit_columns(status: str, statuses: list[str], declared: str, estimated: str) -> list[Column]:
    """Aggregates: events, known counts and sums of both amounts, and a count for each status and ``unknown``.

    Status counts are all null when no event of the key has a status.
    """
    has, s = F.count(status), F.col(status)
    counts = [F.when(has > 0, F.count_if(s == x)).alias(f"{x}_count") for x in statuses]
    other = F.when(has > 0, F.count_if(s.isNotNull() & ~s.isin(statuses))).alias("unknown_count")
    return [F.count("*").alias("event_count"), *_known(F.col(declared), "declared"), *_known(F.col(estimated), "estimated"), *counts, other]


def permit_rollup(events: DataFrame, keys: list[str], status: str, statuses: list[str], declared: str, estimated: str) -> DataFrame:
    return events.groupBy(*keys).agg(*permit_columns(status, statuses, declared, estimated))


def appeal_columns(outcome: str, explicit: list[str], change: str) -> list[Column]:
    """Aggregates: events, counts of explicit outcomes (null unless there is some), unknown ones, and value changes."""
    o, v = F.col(outcome), F.col(change)
    some = F.count_if(o.isin(explicit)) > 0
    counts = [F.when(some, F.count_if(o == x)).alias(f"{x}_count") for x in explicit]
    return [
        F.count("*").alias("event_count"), *counts, F.count_if(o.isNull() | ~o.isin(explicit)).alias("unknown_count"), F.count(v).alias("change_known"),
        F.sum(v).alias("change_total"), F.sum(F.when(v < 0, v)).alias("reduction_total"), F.sum(F.when(v > 0, v)).alias("increase_total"),
    ]


def appeal_rollup(events: DataFrame, keys: list[str], outcome: str, explicit: list[str], change: str) -> DataFrame:
    return events.groupBy(*keys).agg(*appeal_columns(outcome, explicit, change))


def payment_rollup(payments: DataFrame, keys: list[str], fetch: str, fetched_at: str, date: str, amount: str, placeholder: Column) -> DataFrame:
    """Of the fetches of each key the one with most usable payments, then the latest: count, sum, first, last, placeholder.

    A payment is usable with both date and amount.  Fetches with neither a usable payment nor a placeholder row do not count.
    """
    usable = F.col(date).isNotNull() & F.col(amount).isNotNull()
    by_fetch = payments.groupBy(*keys, fetch).agg(
        F.max(fetched_at).alias("__at"), F.count_if(usable).alias("payment_count"), F.sum(F.when(usable, F.col(amount))).alias("payment_total"),
        F.min(F.when(usable, F.col(date))).alias("first_payment"), F.max(F.when(usable, F.col(date))).alias("last_payment"), F.max(placeholder).alias("has_placeholder"),
    )
    some = by_fetch.where((F.col("payment_count") > 0) | F.col("has_placeholder"))
    return best_row(some, keys, [F.desc("payment_count"), F.desc_nulls_last("__at"), F.desc(fetch)]).drop("__at")


def resolve_parcels(events: DataFrame, parcels: DataFrame, number: str, own: str = "parcel_id") -> DataFrame:
    """events with ``resolved``: the own id, else the only parcel with that number, else the only one with it formatted.

    parcels: parcel_id, direct, formatted.  A number with several direct parcels gives null and no second try.
    """
    def index(col: str, name: str) -> DataFrame:
        found = parcels.where(F.col(col).isNotNull()).groupBy(F.col(col).alias(f"__{name}"))
        return found.agg(F.countDistinct("parcel_id").alias(f"__{name}_n"), F.min("parcel_id").alias(f"__{name}_id"))

    a, b = index("direct", "a"), index("formatted", "b")
    both = events.join(a, events[number] == a["__a"], "left").join(b, events[number] == b["__b"], "left")
    by_number = F.when(F.col("__a_n") == 1, F.col("__a_id")).when(F.col("__a_n").isNull() & (F.col("__b_n") == 1), F.col("__b_id"))
    return both.withColumn("resolved", F.coalesce(F.col(own), by_number)).drop("__a", "__a_n", "__a_id", "__b", "__b_n", "__b_id")


def assemble(universe: DataFrame, keys: list[str], **parts: DataFrame) -> DataFrame:
    """One wide row for each key: every part left-joined, its other columns prefixed by its name."""
    out = universe
    for name, part in parts.items():
        renamed = part.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in part.columns if c not in keys])
        out = out.join(renamed, keys, "left")
    return out


def replace_scope(old: DataFrame, new: DataFrame, scope: Column) -> DataFrame:
    """old without the rows in scope, and the new rows: a scoped delete and insert, to be written to a new place."""
    return old.where(~F.coalesce(scope, F.lit(False))).unionByName(new)


def key_scope(df: DataFrame, ids: DataFrame | None, key: str) -> DataFrame:
    """None means everything, an empty table nothing."""
    return df if ids is None else df.join(ids.select(key).distinct(), key, "left_semi")
