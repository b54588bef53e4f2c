"""One row, a rank or a run for each key: best records, mid-rank percentiles, prior years, gaps and islands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotlens.operators.features import rounded


def best_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """For each key the row that comes first in ``order`` (columns with asc/desc); end the order with a unique column."""
    at = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(at)).where("__n = 1").drop("__n")


def largest_row(df: DataFrame, keys: list[str], by: list[str], values: list[str] | None = None) -> DataFrame:
    """For each key the values of the row with the largest ``by`` (nulls lowest), pre-aggregated before the shuffle.

    The row travels as one struct, whose further values of simple types only break ties; others go beside their order.
    """
    values = values or [c for c in df.columns if c not in keys]
    more, kinds = [c for c in values if c not in by], dict(df.dtypes)
    if any("<" in kinds.get(c, "<") or kinds[c] == "variant" for c in more):
        top = F.max_by(F.struct(*values), F.struct(*by)).alias("__top")
        return df.groupBy(*keys).agg(top).select(*keys, "__top.*")
    top = F.max(F.struct(*by, *more)).alias("__top")
    return df.groupBy(*keys).agg(top).select(*keys, *[F.col("__top")[c].alias(c) for c in values])


def mid_rank_percentile(df: DataFrame, groups: list[str], value: str, name: str, least: int = 2, digits: int = 4) -> DataFrame:
    """df with ``name``: (values below + half the equal ones) / n within the group, over non-null values, null if n < least.

    Rows are counted by (group, value) first, so a group's window holds its distinct values only.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("__eq"))
    upto = F.sum("__eq").over(Window.partitionBy(*groups).orderBy(value))
    total = F.sum("__eq").over(Window.partitionBy(*groups))
    share = rounded((upto - F.col("__eq") * F.lit(0.5)) / total, digits)
    ranked = counts.select(*groups, value, F.when(total >= least, share).alias(name))
    same = ranked.select(*[F.col(c).alias(f"__{c}") for c in [*groups, value]], name)
    on = [df[c].eqNullSafe(same[f"__{c}"]) for c in groups] + [df[value] == same[f"__{value}"]]
    return df.join(same, on, "left").select(*df.columns, name)


def prior_year(keys: list[str], year: str, value: str) -> Column:
    """The value exactly one year before, not that of the previous row; for use over one row a key and year."""
    at = Window.partitionBy(*keys).orderBy(year).rangeBetween(-1, -1)
    return F.first(value).over(at)


def recent_sum(keys: list[str], year: str, value: str, years: int) -> Column:
    """Sum over this and the ``years`` years before; 0 becomes null."""
    at = Window.partitionBy(*keys).orderBy(year).rangeBetween(-years, 0)
    return F.nullif(F.sum(value).over(at), F.lit(0))


def runs_of_years(df: DataFrame, keys: list[str], year: str, same: list[str], least: int) -> DataFrame:
    """Runs of at least ``least`` consecutive years with equal values of ``same``: keys, same, first, last and n years."""
    distinct = df.select(*keys, *same, year).distinct()
    at = Window.partitionBy(*keys, *same).orderBy(year)
    island = distinct.withColumn("__island", F.col(year) - F.dense_rank().over(at))
    found = island.groupBy(*keys, *same, "__island").agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.count("*").alias("n_years"))
    return found.where(F.col("n_years") >= least).drop("__island")


def in_long_run(df: DataFrame, same: list[str], year: str, least: int, name: str = "in_run") -> DataFrame:
    """df with ``name``: whether the row's year lies in a run of at least ``least`` consecutive years with equal values of ``same``.

    Nulls in ``same`` equal each other; a row without a year is in no run.  One shuffle by ``same`` serves both windows,
    since the islands of a key lie where the key lies.
    """
    key = Window.partitionBy(*same)
    island = F.col(year) - F.dense_rank().over(key.orderBy(F.col(year).asc_nulls_first()))
    own = Window.partitionBy(*same, "__island")
    long = F.max(year).over(own) - F.min(year).over(own) + 1 >= least
    return df.withColumn("__island", island).withColumn(name, F.coalesce(F.col(year).isNotNull() & long, F.lit(False))).drop("__island")


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) in a total order; Spark keeps offset + limit rows of each task."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)
