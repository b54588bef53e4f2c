"""Exact order statistics and as-of look-ups that split a large group over tasks.

A group's values are counted by value, summed into a bounded number of buckets that follow the order of the values, and
only the buckets that hold a wanted rank are looked at by value.  No buffer and no window holds a whole group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Buckets for each power of e: a bucket spans 1/64 of its values' size.  The offset keeps both signs apart from zero.
FINE, _APART = 64, 100_000


def bucket_of(value: Column) -> Column:
    """A number that never falls as a numeric value rises; null for null, the last one for NaN."""
    x = value.cast("double")
    steps = F.floor(F.least(F.log(F.abs(x)) * FINE, F.lit(_APART - 1.0))) + _APART  # infinity comes last
    return F.when(F.isnan(x), 2 * _APART).when(x > 0, steps).when(x < 0, -steps).when(x == 0, F.lit(0)).cast("long")


def _ranks(kind: tuple[str, float], n: Column) -> tuple[Column, Column]:
    """The two ranks, from 1, whose values make a statistic: alike for the nearest rank, the middle two for a median."""
    name, p = kind
    if name == "middle":
        return F.floor((n + 1) / 2).cast("long"), (F.floor(n / 2) + 1).cast("long")
    at = F.greatest(F.lit(1), F.ceil(n * F.lit(p))).cast("long")
    return at, at


MEDIAN = ("middle", 0.5)


def nearest_rank(p: float) -> tuple[str, float]:
    return ("nearest", p)


def order_statistics(df: DataFrame, groups: list[str], value: str, picks: dict[str, tuple[str, float]], sums: dict[str, Column] | None = None, spread: str | None = None) -> DataFrame:
    """For each group: n (known values), total (their sum), each pick, each sum, and with ``spread`` (a MEDIAN pick) the sum
    of absolute deviations from it as ``deviation``.

    picks are MEDIAN or nearest_rank(p), by name; sums are additive: a column of numbers to add up over all rows of the
    group, those without a value included.  The rows are read and counted once: the counts by bucket and those by value
    of the few buckets that hold a rank come from the same shuffle.  Null groups are groups; a group without a known value
    has null picks; an empty table gives no rows.
    """
    sums = sums or {}
    names = [f"__s_{k}" for k in sums]
    counts = df.groupBy(*groups, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(f"__s_{k}") for k, c in sums.items()])
    counts = counts.withColumn("__b", bucket_of(F.col("__v"))).withColumn("__t", F.col("__v").cast("double") * F.col("__n"))
    added = lambda: [F.sum(c).alias(c) for c in ("__n", "__t", *names)]
    by_bucket = counts.groupBy(*groups, "__b").agg(*added())
    known = F.when(F.col("__b").isNotNull(), F.col("__n")).otherwise(F.lit(0))
    every = Window.partitionBy(*groups)
    upto = F.sum(known).over(every.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0))
    placed = by_bucket.withColumns({"__before": upto - known, "__all": F.sum(known).over(every)})
    ranks = {k: _ranks(p, F.col("__all")) for k, p in picks.items()}
    holds = lambda at: (F.col("__before") < at) & (at <= F.col("__before") + F.col("__n")) & F.col("__b").isNotNull()
    hit = reduce(lambda a, b: a | b, [holds(at) for two in ranks.values() for at in two])
    placed = placed.withColumn("__hit", hit)
    # buckets without a rank count as a whole; the others give way to their values
    whole = placed.where("not __hit").select(*groups, F.lit(None).cast(counts.schema["__v"].dataType).alias("__v"), "__b", "__before", "__all", "__n", "__t", *names)
    wanted = placed.where("__hit").select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.col("__b").alias("__wb"), "__before", "__all")
    same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)] + [F.col("__b").eqNullSafe(F.col("__wb"))]
    inside = counts.join(wanted, reduce(lambda a, b: a & b, same))
    within = F.sum("__n").over(Window.partitionBy(*groups, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("__before", F.col("__before") + within - F.col("__n")).select(*whole.columns)
    rows = whole.unionByName(inside)
    is_known = F.col("__b").isNotNull()
    at = lambda rank: F.max(F.when(F.col("__v").isNotNull() & (F.col("__before") < rank) & (rank <= F.col("__before") + F.col("__n")), F.col("__v")))
    aggs = [F.sum(F.when(is_known, F.col("__n")).otherwise(F.lit(0))).alias("n"), F.sum("__t").alias("total"), *[F.sum(f"__s_{k}").alias(k) for k in sums]]
    for k, (low, high) in ranks.items():
        aggs += [at(low).alias(f"__low_{k}"), at(high).alias(f"__high_{k}")]
    if spread:
        below = is_known & (F.col("__before") < ranks[spread][0])
        aggs += [F.sum(F.when(c, F.col(x))).alias(f"__{name}{x}") for name, c in (("below", below), ("above", is_known & ~below)) for x in ("__n", "__t")]
    found = rows.groupBy(*groups).agg(*aggs)
    out = {}
    for k, (kind, _) in picks.items():
        low, high = F.col(f"__low_{k}"), F.col(f"__high_{k}")
        out[k] = low if kind == "nearest" else (low.cast("double") + high.cast("double")) / 2
    if spread:
        part = lambda c: F.coalesce(F.col(c), F.lit(0.0))
        out["deviation"] = out[spread] * (part("__below__n") - part("__above__n")) - part("__below__t") + part("__above__t")
    return found.select(*groups, "n", "total", *[c.alias(k) for k, c in out.items()], *sums)


def as_of(checks: DataFrame, events: DataFrame, by: list[str], at: str, value: str = "last_at", unit: str | int = "hour") -> DataFrame:
    """checks (by, at, and any others) with the time of the latest event of the same ``by`` that is not after each, null if there is none.

    Two levels, so that a key with many events is many tasks: events and checks of one ``unit`` of time meet in a window,
    and the last event of each unit is carried over the units, of which a key has as many as its span of time holds.
    Null times of events are no events; a check without a time finds none.  Times may be numbers, with a number as unit
    (3600 if none is given).
    """
    numbers = isinstance(events.schema[at].dataType, NumericType)
    span = F.floor(F.col(at) / (3600 if isinstance(unit, str) else unit)) if numbers else F.date_trunc(unit, F.col(at))
    own = events.where(F.col(at).isNotNull()).select(*by, at, span.alias("__unit"))
    others = [c for c in checks.columns if c not in by and c != at]
    asked = checks.select(*by, at, F.struct(*[F.col(c) for c in others] or [F.lit(0).alias("none")]).alias("__row"), span.alias("__unit"), F.lit(True).alias("__check"))
    both = asked.unionByName(own.withColumn("__check", F.lit(False)), allowMissingColumns=True)
    inside = Window.partitionBy(*by, "__unit").orderBy(at, "__check").rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("__near", F.last(F.when(~F.col("__check"), F.col(at)), ignorenulls=True).over(inside)).where("__check")
    units = both.groupBy(*by, "__unit").agg(F.max(F.when(~F.col("__check"), F.col(at))).alias("__last"))
    earlier = Window.partitionBy(*by).orderBy("__unit").rowsBetween(Window.unboundedPreceding, -1)
    carried = units.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], F.col("__unit").alias("__u"), F.last("__last", ignorenulls=True).over(earlier).alias("__far"))
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(by)] + [F.col("__unit") == F.col("__u")]
    found = near.join(carried, reduce(lambda a, b: a & b, same), "left")
    return found.select(*by, at, *[F.col(f"__row.{c}").alias(c) for c in others], F.coalesce("__near", "__far").alias(value))
