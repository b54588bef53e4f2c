"""Sales-ratio study: assessed value against price, by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotlens.operators.order import MEDIAN, order_statistics


def candidates(sales: DataFrame, matches: DataFrame, exclusions: DataFrame, txn: str = "txn") -> DataFrame:
    """sales with the parcel of their primary match and ``excluded``: whether there is an active exclusion.

    matches: txn, parcel_id, is_primary; exclusions: txn, is_active.  Sales without a primary match are left out; several
    exclusions count once.
    """
    primary = matches.where("is_primary").select(txn, "parcel_id")
    active = exclusions.where("is_active").select(txn).distinct().withColumn("__active", F.lit(True))
    both = sales.join(primary, txn).join(active, txn, "left")
    return both.withColumn("excluded", F.col("__active").isNotNull()).drop("__active")


def label_sales(sales: DataFrame, groups: list[str], assessed: str, price: str, excluded: Column, in_scope: Column | None = None) -> DataFrame:
    """sales with ``outcome``, the first that applies: no_fact, blank_group, out_of_scope, excluded, no_value, included.

    ``sales`` are already left-joined to their facts; ``has_fact`` says whether there was one.
    """
    blank = F.lit(False)
    for g in groups[1:]:
        blank = blank | F.coalesce(F.trim(g), F.lit("")).eqNullSafe("")
    value = F.col(assessed).cast("double")
    outcome = (
        F.when(~F.col("has_fact"), "no_fact")
        .when(blank, "blank_group")
        .when(~(F.lit(True) if in_scope is None else in_scope), "out_of_scope")
        .when(excluded, "excluded")
        .when(value.isNull() | (value < 0), "no_value")
        .otherwise("included")
    )
    return sales.withColumn("outcome", outcome).withColumn("ratio", F.when(F.col("outcome") == "included", value / F.col(price).cast("double")))


def ratio_study(labelled: DataFrame, groups: list[str], assessed: str, price: str, low: float = 0.5, high: float = 1.5) -> DataFrame:
    """For each group: n, excluded, median ratio, COD, PRD and outliers; COD and PRD need two ratios.

    COD = 100 * sum |r - median| / (n * median); PRD = mean ratio / (sum assessed / sum price).
    """
    rows = labelled.where(F.col("outcome").isin("included", "excluded"))
    r = F.col("ratio")
    one = lambda cond: F.when(cond, 1).otherwise(0)
    kept = lambda c: F.when(r.isNotNull(), F.col(c).cast("double"))
    sums = {"n_excluded": one(F.col("outcome") == "excluded"), "assessed": kept(assessed), "paid": kept(price), "n_low": one(r < low), "n_high": one(r > high)}
    found = order_statistics(rows, groups, "ratio", {"median": MEDIAN}, sums, spread="median")
    enough = F.col("n") >= 2
    cod = F.try_divide(F.col("deviation"), F.col("n") * F.col("median")) * 100
    prd = F.try_divide(F.try_divide(F.col("total"), F.col("n")), F.try_divide(F.col("assessed"), F.col("paid")))
    return found.select(
        *groups, "n", "n_excluded", F.round("median", 6).alias("median_ratio"), F.when(enough, F.round(cod, 4)).alias("cod"),
        F.when(enough, F.round(prd, 4)).alias("prd"), "n_low", "n_high",
    )


def outcome_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("outcome").agg(F.count("*").alias("n"))


def years_without_sales(labelled: DataFrame, years: DataFrame, year: str) -> DataFrame:
    """The requested years in which no sale was a candidate."""
    return years.join(labelled.select(year).distinct(), year, "left_anti")
