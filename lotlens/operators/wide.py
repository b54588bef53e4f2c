"""The wide parcel-year fact: all sources in one tagged union, and one grouped aggregate that picks winners and sums at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The columns that a fact row takes from its sources, and the states that are counted.
SUMMARY_FIELDS = ["municipality_name", "parcel_description", "owner_name", "primary_address", "billing_address"]
ASSESSMENT_FIELDS = ["valuation_classification", "assessment_acres", "land_value", "improved_value", "total_value", "average_assessment_ratio", "estimated_fair_market_value", "valuation_date"]
TAX_FIELDS = ["total_assessed_value", "assessed_land_value", "assessed_improvement_value", "taxes", "specials", "first_dollar_credit", "lottery_credit", "amount"]
PERMIT_STATUSES = ["applied", "issued", "finaled", "cancelled", "expired", "unknown"]
APPEAL_OUTCOMES = ["reduction_granted", "partial_reduction", "denied", "withdrawn", "dismissed", "pending"]

_OUT = {
    "municipality_name": "municipality_name", "parcel_description": "current_parcel_description", "owner_name": "current_owner_name", "primary_address": "current_primary_address",
    "billing_address": "current_billing_address", "assessment_acres": "assessment_acres", "taxes": "tax_taxes",
}
_KEYS = ["parcel_id", "year"]


def _known(fields: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(f).isNotNull().cast("int") for f in fields])


def _moment() -> Column:
    """When a record was fetched and by which fetch, for ranking: unknown times come first."""
    return F.struct(F.coalesce(F.col("fetched_at").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")).alias("at"), F.coalesce("fetch_id", F.lit(-1)).alias("fetch"))


def _fields(kind: str, fields: list[str], columns: list[str] | None) -> list[str]:
    """Those of a source's fields that are asked for."""
    return [f for f in fields if columns is None or _OUT.get(f, f"{kind}_{f}") in columns]


def _tagged(summaries: DataFrame, assessments: DataFrame, taxes: DataFrame, payments: DataFrame, permits: DataFrame, appeals: DataFrame, columns: list[str] | None) -> list[DataFrame]:
    """The sources as rows (parcel_id, year, pay_fetch, and a struct or amounts of their own); years but for summaries are known.

    A record that must not win (a valuation breakout, a tax row that is no summary, a payment of a detail page) still
    makes its parcel-year a fact.
    """
    dated = lambda df: df.where(F.col("year").isNotNull())
    rank = F.when(F.col("source") == "detail", 3).when(F.col("source") == "summary", 2).otherwise(1)
    body = lambda kind, fields: F.struct("fetch_id", *_fields(kind, fields, columns))
    of_payments = F.lit(columns is None or any(c.startswith("payment_") for c in columns))  # else their rows need not be kept apart by fetch
    summary = summaries.select("parcel_id", F.lit(None).cast("int").alias("year"), F.struct(_moment().alias("rank"), body("summary", SUMMARY_FIELDS).alias("row")).alias("summary"))
    best = F.struct(F.struct(rank.alias("source"), _known(ASSESSMENT_FIELDS).alias("known"), _moment().alias("moment"), F.col("id")).alias("rank"), body("assessment", ASSESSMENT_FIELDS).alias("row"))
    assessment = dated(assessments).select(*_KEYS, F.when(~F.col("source").eqNullSafe("valuation_breakout"), best).alias("assessment"))
    best = F.struct(F.struct(_known(TAX_FIELDS).alias("known"), _moment().alias("moment"), F.col("id")).alias("rank"), body("tax", TAX_FIELDS).alias("row"))
    tax = dated(taxes).select(*_KEYS, F.when(F.col("source") == "summary", best).alias("tax"))
    counts = ~F.col("source").eqNullSafe("tax_detail_payments")
    usable = counts & F.col("date").isNotNull() & F.col("paid").isNotNull()
    payment = dated(payments).withColumnRenamed("amount", "paid").select(
        *_KEYS, F.when(counts & of_payments, F.col("fetch_id")).alias("pay_fetch"), F.when(counts, _moment()).alias("pay_moment"), F.when(usable, F.col("paid")).alias("pay_amount"),
        F.when(usable, F.col("date")).alias("pay_date"), F.when(counts, F.coalesce("placeholder", F.lit(False))).alias("pay_placeholder"),
    )
    permit = dated(permits).select(*_KEYS, F.lit(True).alias("is_permit"), F.col("status").alias("permit_status"), F.col("declared").alias("permit_declared"), F.col("estimated").alias("permit_estimated"))
    appeal = dated(appeals).select(*_KEYS, F.lit(True).alias("is_appeal"), F.col("outcome").alias("appeal_outcome"), F.col("change").alias("appeal_change"))
    return [summary, assessment, tax, payment, permit, appeal]


def _counted(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def _sums() -> dict[str, Column]:
    """Additive aggregates of permits and appeals, by name."""
    permit, appeal = F.col("is_permit").isNotNull(), F.col("is_appeal").isNotNull()
    status, outcome, change = F.col("permit_status"), F.col("appeal_outcome"), F.col("appeal_change")
    out = {"n_permits": _counted(permit), "declared_known": F.count("permit_declared"), "declared_sum": F.sum("permit_declared"), "estimated_known": F.count("permit_estimated")}
    out |= {"estimated_sum": F.sum("permit_estimated"), "with_status": _counted(permit & status.isNotNull())}
    out |= {f"permit_{s}": _counted(status.eqNullSafe(s)) for s in PERMIT_STATUSES}
    explicit = F.coalesce(outcome.isin(APPEAL_OUTCOMES), F.lit(False))
    out |= {"n_appeals": _counted(appeal), "appeal_explicit": _counted(appeal & explicit), "appeal_unknown": _counted(appeal & ~explicit)}
    out |= {f"appeal_{o}": _counted(outcome.eqNullSafe(o)) for o in APPEAL_OUTCOMES}
    return out | {"change_known": F.count("appeal_change"), "change_total": F.sum(change), "change_down": F.sum(F.when(change < 0, change)), "change_up": F.sum(F.when(change > 0, change))}


def parcel_year_facts(summaries: DataFrame, assessments: DataFrame, taxes: DataFrame, payments: DataFrame, permits: DataFrame, appeals: DataFrame, money: str = "decimal(14,2)", columns: list[str] | None = None) -> DataFrame:
    """One row for each parcel and year that any dated source names.

    summaries: parcel_id, fetch_id, fetched_at and SUMMARY_FIELDS; the latest fetch counts for all years of a parcel.
    assessments, taxes: parcel_id, year, id, fetch_id, fetched_at, source and their fields; the best one counts (detail
    before summary before others for assessments, summaries only for taxes, then the most known fields, the latest fetch,
    the largest id).  payments: parcel_id, year, fetch_id, fetched_at, source, date, amount, placeholder; the fetch with
    the most usable payments counts, then the latest.  permits: parcel_id, year, status, declared, estimated; appeals:
    parcel_id, year, outcome, change: resolved to parcels before.

    The union is combined before it is shuffled, so no key is large; that is the only shuffle of source rows.  What is
    left, a row for each payment fetch of a parcel-year, is dealt by parcel once, for the choice of the fetch, the years
    before, and the parcel's summary.  With ``columns`` only these are made, beside the keys, and nothing else travels.
    """
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), _tagged(summaries, assessments, taxes, payments, permits, appeals, columns))
    sums = _sums()
    by_fetch = union.groupBy(*_KEYS, "pay_fetch").agg(
        F.max("summary").alias("summary"), F.max("assessment").alias("assessment"), F.max("tax").alias("tax"),
        F.max("pay_moment").alias("moment"), F.count("pay_amount").alias("n_paid"), F.sum("pay_amount").alias("paid"), F.min("pay_date").alias("first_paid"), F.max("pay_date").alias("last_paid"),
        F.max("pay_placeholder").alias("placeholder"), *[c.alias(k) for k, c in sums.items()],
    )
    fetched = F.when((F.col("n_paid") > 0) | F.col("placeholder"), F.struct(F.struct("n_paid", "moment", "pay_fetch").alias("rank"), F.struct("pay_fetch", "n_paid", "paid", "first_paid", "last_paid", "placeholder").alias("row")))
    by_year = by_fetch.withColumn("payment", fetched).repartition("parcel_id").groupBy(*_KEYS).agg(
        *[F.max(c).alias(c) for c in ("summary", "assessment", "tax", "payment")], *[F.sum(k).alias(k) for k in sums],
    )
    parcel = Window.partitionBy("parcel_id")
    back = lambda years: F.sum("n_permits").over(parcel.orderBy("year").rangeBetween(-years, 0))
    rows = by_year.withColumns({"summary": F.max("summary").over(parcel), "recent_1y": back(1), "recent_2y": back(2)}).where(F.col("year").isNotNull())
    out = [F.col(k) for k in _KEYS]
    out += [F.col(f"{s}.row.fetch_id").alias(f"{name}_fetch_id") for s, name in (("summary", "parcel_summary"), ("assessment", "assessment"), ("tax", "tax"))] + [F.col("payment.row.pay_fetch").alias("payment_fetch_id")]
    out += [F.col(f"summary.row.{f}").alias(_OUT[f]) for f in _fields("summary", SUMMARY_FIELDS, columns)]
    out += [F.col(f"assessment.row.{f}").alias(_OUT.get(f, f"assessment_{f}")) for f in _fields("assessment", ASSESSMENT_FIELDS, columns)]
    out += [F.col(f"tax.row.{f}").alias(_OUT.get(f, f"tax_{f}")) for f in _fields("tax", TAX_FIELDS, columns)]
    out += [F.col(f"payment.row.{a}").alias(f"payment_{b}") for a, b in (("n_paid", "event_count"), ("paid", "total_amount"), ("first_paid", "first_date"), ("last_paid", "last_date"), ("placeholder", "has_placeholder_row"))]
    if_any = lambda n, c: F.when(F.col(n) > 0, c)
    out += [if_any("n_permits", F.col(a)).alias(f"permit_{b}") for a, b in (("n_permits", "event_count"), ("declared_known", "declared_valuation_known_count"), ("declared_sum", "declared_valuation_sum"), ("estimated_known", "estimated_cost_known_count"), ("estimated_sum", "estimated_cost_sum"))]
    out += [if_any("with_status", F.col(f"permit_{s}")).alias(f"permit_status_{s}_count") for s in PERMIT_STATUSES]
    out += [if_any(c, F.col(c)).alias(f"permit_{c}_count") for c in ("recent_1y", "recent_2y")] + [if_any(c, F.lit(True)).alias(f"permit_has_{c}") for c in ("recent_1y", "recent_2y")]
    out += [if_any("n_appeals", F.col("n_appeals")).alias("appeal_event_count")] + [if_any("appeal_explicit", F.col(f"appeal_{o}")).alias(f"appeal_{o}_count") for o in APPEAL_OUTCOMES]
    out += [if_any("n_appeals", F.col(a)).alias(f"appeal_{b}") for a, b in (("appeal_unknown", "unknown_outcome_count"), ("change_known", "value_change_known_count"))]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast(money)
    out += [if_any("change_known", F.col("change_total").cast(money)).alias("appeal_value_change_total")]
    out += [if_any("change_known", zero(a)).alias(f"appeal_value_change_{b}_total") for a, b in (("change_down", "reduction"), ("change_up", "increase"))]
    found = rows.select(*out)
    return found if columns is None else found.select(*_KEYS, *columns)
