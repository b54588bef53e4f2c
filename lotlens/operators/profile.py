"""Profiles: counts and coverage of source tables, presence of fields, and their snapshot as metric rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _rate(num: Column, den: Column) -> Column:
    return F.when(den > 0, F.round(num / den, 4))


def counts(fetches: DataFrame, parcels: DataFrame, per_parcel: dict[str, DataFrame], sections: dict[str, DataFrame], fetch: str = "fetch_id", parcel: str = "parcel_id", years: dict[str, DataFrame] | None = None) -> DataFrame:
    """(name, n): fetches, successful, parsed and failed ones, parcels, parcels of each table, successful fetches without rows of a section.

    fetches: fetch, status_code, parsed_at, parse_error; sections: fetch; years: tables (parcel, year) whose distinct parcel-years count.
    """
    rows = fetches
    for name, df in sections.items():
        rows = rows.join(df.select(fetch).distinct().withColumn(f"__{name}", F.lit(True)), fetch, "left")
    ok = F.col("status_code") == 200
    found = {"fetches": F.count("*"), "successful_fetches": F.count_if(ok), "parsed_fetches": F.count("parsed_at"), "parse_errors": F.count("parse_error")}
    found |= {f"missing_{name}": F.count_if(ok & F.col(f"__{name}").isNull()) for name in sections}
    wide = rows.agg(*[c.alias(n) for n, c in found.items()])
    long = [wide.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in found])).alias("c")).select("c.*")]
    for name, df in {"parcels": parcels, **{f"{n}_parcels": d for n, d in per_parcel.items()}}.items():
        long.append(df.agg(F.countDistinct(parcel).alias("n")).select(F.lit(name).alias("name"), "n"))
    for name, df in (years or {}).items():
        long.append(df.where(F.col("year").isNotNull()).agg(F.countDistinct(parcel, "year").alias("n")).select(F.lit(name).alias("name"), "n"))
    return reduce(DataFrame.unionByName, long)


#: The coverage metrics that the drift check compares; what a profile has besides is left out of a snapshot.
DRIFT_COVERAGE = [
    "coverage.parsed_successful_fetch_rate", "coverage.parse_error_successful_fetch_rate", "coverage.parcel_summary_parcel_rate", "coverage.parcel_year_fact_parcel_rate",
    "coverage.parcel_year_fact_source_year_rate", "coverage.parcel_characteristic_parcel_rate", "coverage.parcel_lineage_parcel_rate",
]


def coverage(named: DataFrame, per_parcel: list[str], sections: list[str]) -> DataFrame:
    """(metric, num, den, rate) from the rows of ``counts``.  The parsed rate counts all parsed fetches over the successful ones.

    The rate of source years is there if parcel_year_facts and source_parcel_years were counted.
    """
    pairs = {
        "coverage.successful_fetch_rate": ("successful_fetches", "fetches"), "coverage.parsed_successful_fetch_rate": ("parsed_fetches", "successful_fetches"),
        "coverage.parse_error_successful_fetch_rate": ("parse_errors", "successful_fetches"), "coverage.parcel_year_fact_source_year_rate": ("parcel_year_facts", "source_parcel_years"),
    }
    pairs |= {f"coverage.{n}_parcel_rate": (f"{n}_parcels", "parcels") for n in per_parcel}
    pairs |= {f"selector_miss.{n}_fetch_rate": (f"missing_{n}", "successful_fetches") for n in sections}
    names = sorted({x for pair in pairs.values() for x in pair})
    wide = named.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])
    long = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(a).alias("num"), F.col(b).alias("den")) for m, (a, b) in pairs.items()])
    found = wide.select(F.explode(long).alias("m")).select("m.*", _rate(F.col("m.num"), F.col("m.den")).alias("rate"))
    return found.where("num is not null and den is not null")


def field_presence(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(field, num, den, rate): rows whose field holds something; empty texts, lists and maps count as missing."""
    def filled(name: str) -> Column:
        kind = rows.schema[name].dataType
        if isinstance(kind, T.StringType):
            return F.col(name) != ""
        return F.size(name) > 0 if isinstance(kind, (T.ArrayType, T.MapType)) else F.col(name).isNotNull()

    wide = rows.agg(F.count("*").alias("__den"), *[F.count_if(filled(f)).alias(f) for f in fields])
    long = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("num"), F.col("__den").alias("den")) for f in fields])
    return wide.select(F.explode(long).alias("m")).select("m.*", _rate(F.col("m.num"), F.col("m.den")).alias("rate"))


def snapshot(covered: DataFrame, presence: DataFrame) -> DataFrame:
    """Metric rows for the drift check: coverage, misses of sections, presence of detail fields, and their null rates."""
    covered = covered.where(F.col("metric").isin(DRIFT_COVERAGE) | F.col("metric").startswith("selector_miss."))
    there = presence.select(F.concat(F.lit("tax_detail_field_presence."), "field", F.lit(".rate")).alias("metric"), "num", "den", "rate")
    lacking = F.col("den") - F.col("num")
    absent = presence.select(F.concat(F.lit("extraction_null_rate."), "field").alias("metric"), lacking.alias("num"), "den", _rate(lacking, F.col("den")).alias("rate"))
    return covered.unionByName(there).unionByName(absent)
