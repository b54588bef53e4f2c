"""Features of a parcel-year: ratios, peers, permits, appeals, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """value, a double, with ``digits`` decimals: its product with 10 ** digits is rounded, halves away from zero.

    ``round`` of a double goes by its shortest decimal text instead, and so moves another way at some ties.
    """
    factor = F.lit(float(10**digits))
    return F.round(value * factor) / factor


def change_pct(current: Column, prior: Column, digits: int = 6) -> Column:
    """(current - prior) / prior, null unless prior is positive."""
    return F.when(prior > 0, rounded((current.cast("double") - prior.cast("double")) / prior.cast("double"), digits))


def assessment_ratio(assessed: Column, price: Column) -> tuple[Column, Column]:
    """(assessed / price at six digits, flag): missing_assessment, missing_sale or invalid_sale where there is none."""
    a, p = assessed.cast("double"), price.cast("double")
    flag = F.when(a.isNull(), "missing_assessment").when(p.isNull(), "missing_sale").when(p <= 0, "invalid_sale")
    return F.when(flag.isNull(), rounded(F.try_divide(a, p), 6)), flag


def expected_permit_change(events: Column, declared_n: Column, declared: Column, estimated_n: Column, estimated: Column, share: float = 0.75) -> Column:
    """struct(value, basis, flag): share of the only amount that is fully known.

    Both or neither fully known: unresolved_permit_basis; a known amount without sum, or amounts without events:
    missing_permit_context; no events at all: 0 and permit_zero_signal_inferred.
    """
    events, dn, en = (F.coalesce(c, F.lit(0)) for c in (events, declared_n, estimated_n))
    by_declared, by_estimated = dn == events, en == events
    one = by_declared != by_estimated
    amount = F.when(by_declared, declared).otherwise(estimated)
    stray = (dn > 0) | (en > 0) | (F.coalesce(declared, F.lit(0)) != 0) | (F.coalesce(estimated, F.lit(0)) != 0)
    value = F.when(events > 0, F.when(one, F.round(amount * F.lit(share).cast("decimal(4,2)"), 2))).when(~stray, F.lit(0))
    basis = F.when((events > 0) & one & amount.isNotNull(), F.when(by_declared, "declared").otherwise("estimated")).when((events == 0) & ~stray, "none")
    flag = F.when(events > 0, F.when(~one, "unresolved_permit_basis").when(amount.isNull(), "missing_permit_context")).otherwise(
        F.when(stray, "missing_permit_context").otherwise("permit_zero_signal_inferred")
    )
    return F.struct(value.cast("double").alias("value"), basis.alias("basis"), flag.alias("flag"))


def permit_gap(current: Column, prior: Column, expected: Column) -> Column:
    """(current - prior) - expected."""
    return (current - prior) - expected


def appeal_window(df: DataFrame, keys: list[str], year: str, events: str, delta: str, granted: str, unknown: str, years: int = 2) -> DataFrame:
    """df (one row a key and year) with appeal_delta and appeal_rate over this and the ``years`` years before.

    The delta is null if a year with events lacks it; the rate is null if such a year has unknown or uncounted outcomes.
    """
    at = Window.partitionBy(*keys).orderBy(year).rangeBetween(-years, 0)
    has = F.coalesce(F.col(events), F.lit(0)) > 0
    lacks = F.sum(F.when(has & F.col(delta).isNull(), 1).otherwise(0)).over(at)
    vague = F.sum(F.when(has & (F.col(granted).isNull() | (F.coalesce(F.col(unknown), F.lit(0)) > 0)), 1).otherwise(0)).over(at)
    n = F.sum(F.when(has, F.col(events)).otherwise(0)).over(at)
    won = F.sum(F.when(has, F.col(granted)).otherwise(0)).over(at)
    total = F.sum(F.when(has, F.col(delta))).over(at)
    return df.withColumns({"appeal_delta": F.when((n > 0) & (lacks == 0), total), "appeal_rate": F.when((n > 0) & (vague == 0), rounded(won / n, 4))})


def lineage_reset(rows: DataFrame, edges: DataFrame, values: DataFrame) -> DataFrame:
    """rows(parcel_id, yr, v) with ``reset``: own value less the sum of its parents' values a year before.

    edges: parcel_id, parent_id; values: parcel_id, yr, v.  Without parents 0; null if some parent has no value then.
    """
    before = values.select(F.col("parcel_id").alias("parent_id"), (F.col("yr") + 1).alias("yr"), F.col("v").alias("parent_v"))
    asked = rows.select("parcel_id", "yr").join(edges, "parcel_id")
    sums = asked.join(before, ["parent_id", "yr"], "left").groupBy("parcel_id", "yr").agg(F.count("*").alias("n"), F.count("parent_v").alias("known"), F.sum("parent_v").alias("total"))
    delta = F.when(F.col("n").isNull(), F.lit(0).cast("double")).when(F.col("n") == F.col("known"), (F.col("v") - F.col("total")).cast("double"))
    return rows.join(sums, ["parcel_id", "yr"], "left").withColumn("reset", delta).drop("n", "known", "total")


def quality_flags(*flags: Column) -> Column:
    """Sorted distinct flags, nulls left out."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*flags))))


def validation_errors(**checks: Column) -> Column:
    """Sorted array of the codes whose check is true."""
    return F.array_sort(F.array_compact(F.array(*[F.when(check, code) for code, check in checks.items()])))


# What a feature row's details may say, and the sources that it must refer to.
DETAIL_STATES = ["known", "missing", "none"]
PERMIT_BASES = ["declared", "estimated", "none", "unknown"]
SOURCE_REFS = ["assessment", "sales", "peer_group", "permits", "appeals", "lineage"]


def _sorted_unique(keys: Column) -> Column:
    return keys.eqNullSafe(F.array_sort(F.array_distinct(keys)))


def feature_errors() -> Column:
    """The sorted error codes of a feature row; none for a row that holds together.

    Columns: parcel_id, year, feature_version; the features; permit_basis, appeal_value_detail_status and
    appeal_outcome_detail_status; permit_source_keys and appeal_source_keys (arrays of structs), related_parcel_ids (an
    array), relationship_count, and source_ref_keys (the names of the row's references).  Null arrays are empty.
    """
    col = F.col
    keys = lambda name: F.coalesce(F.size(name), F.lit(0)) > 0
    ordered = lambda name: col(name).isNull() | _sorted_unique(col(name))
    ratio, peer, expected, rate, delta = (col(c) for c in ("assessment_to_sale_ratio", "peer_percentile", "permit_adjusted_expected_change", "appeal_success_rate_3y", "appeal_value_delta_3y"))
    basis, value, outcome = col("permit_basis"), col("appeal_value_detail_status"), col("appeal_outcome_detail_status")
    permits, appeals = keys("permit_source_keys"), keys("appeal_source_keys")
    refs = F.coalesce("source_ref_keys", F.array().cast("array<string>"))
    lineage = F.array_contains(refs, "lineage")
    known = basis.isin("declared", "estimated")
    return validation_errors(
        missing_required_parcel_id=F.coalesce(F.trim("parcel_id") == "", F.lit(True)), invalid_year=F.coalesce(col("year") <= 0, F.lit(True)), missing_required_feature_version=F.coalesce(F.trim("feature_version") == "", F.lit(True)),
        negative_assessment_to_sale_ratio=ratio < 0, out_of_bounds_peer_percentile=(peer < 0) | (peer > 1), peer_percentile_without_ratio=peer.isNotNull() & ratio.isNull(), out_of_bounds_appeal_success_rate_3y=(rate < 0) | (rate > 1),
        permit_basis_none_with_nonzero_expected_change=(basis == "none") & ~expected.eqNullSafe(F.lit(0.0)), permit_basis_none_with_source_keys=(basis == "none") & permits, permit_basis_unknown_with_expected_change=(basis == "unknown") & expected.isNotNull(),
        permit_basis_known_without_expected_change=known & expected.isNull(), permit_basis_known_without_source_keys=known & ~permits, invalid_permit_basis=~F.coalesce(basis.isin(PERMIT_BASES), F.lit(False)),
        permit_source_keys_not_sorted_unique=~ordered("permit_source_keys"), appeal_source_keys_not_sorted_unique=~ordered("appeal_source_keys"),
        invalid_appeal_value_detail_status=~F.coalesce(value.isin(DETAIL_STATES), F.lit(False)), invalid_appeal_outcome_detail_status=~F.coalesce(outcome.isin(DETAIL_STATES), F.lit(False)),
        appeal_value_none_with_value=(value == "none") & delta.isNotNull(), appeal_value_none_with_source_keys=(value == "none") & appeals, appeal_value_known_without_value=(value == "known") & delta.isNull(),
        appeal_value_known_without_source_keys=(value == "known") & ~appeals, appeal_value_missing_with_value=(value == "missing") & delta.isNotNull(), appeal_value_missing_without_source_keys=(value == "missing") & ~appeals,
        appeal_outcome_none_with_rate=(outcome == "none") & rate.isNotNull(), appeal_outcome_none_with_source_keys=(outcome == "none") & appeals, appeal_outcome_missing_with_rate=(outcome == "missing") & rate.isNotNull(),
        appeal_outcome_missing_without_source_keys=(outcome == "missing") & ~appeals, appeal_outcome_known_without_source_keys=(outcome == "known") & ~appeals,
        lineage_related_parcels_not_sorted_unique=~ordered("related_parcel_ids"), missing_source_refs_lineage=~lineage,
        lineage_relationship_count_mismatch=lineage & ~col("relationship_count").eqNullSafe(F.coalesce(F.size("related_parcel_ids"), F.lit(0))), missing_required_source_refs_keys=F.size(F.array_except(F.array(*map(F.lit, SOURCE_REFS)), refs)) > 0,
    )


def validated(rows: DataFrame) -> DataFrame:
    """rows with ``errors``: rows without are kept by a build, the others skipped."""
    return rows.withColumn("errors", feature_errors())


def build_diagnostics(checked: DataFrame, flags: str = "quality_flags") -> DataFrame:
    """(kind, name, n): kept and skipped rows, rows with flags and all flags among the kept ones, and each flag and error, from one scan."""
    entry = lambda kind, name: F.struct(F.lit(kind).alias("kind"), (F.lit(name) if isinstance(name, str) else name).alias("name"))
    kept = F.size("errors") == 0
    own = F.when(kept, F.coalesce(F.col(flags), F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    each = F.transform(own, lambda f: entry("flag", f))
    errors = F.transform("errors", lambda e: entry("error", e))
    warned = F.transform(own, lambda f: entry("rows", "quality_warnings"))
    base = F.array(F.when(kept, entry("rows", "inserted")).otherwise(entry("rows", "skipped")), F.when(F.size(own) > 0, entry("rows", "with_quality_flags")))
    all_of = F.concat(F.array_compact(base), each, errors, warned)
    return checked.select(F.inline(all_of)).groupBy("kind", "name").agg(F.count("*").alias("n"))


def skipped_sample(checked: DataFrame, most: int = 25) -> DataFrame:
    """The first skipped rows by parcel and year, with their errors."""
    return checked.where(F.size("errors") > 0).orderBy("parcel_id", "year").limit(most).select("parcel_id", "year", "errors")
