"""Review queue, outcomes of reviews, calibration views and the review-action validator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotlens.operators.order import MEDIAN, order_statistics

REVIEWED = ["resolved", "closed"]
#: The legal changes of a review's status.
TRANSITIONS = [
    ("pending", "in_review"), ("pending", "resolved"), ("in_review", "pending"), ("in_review", "resolved"), ("resolved", "in_review"),
    ("resolved", "closed"), ("closed", "in_review"),
]


def funnel(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """df with ``dropped_by``: the first stage whose condition does not hold (null counts as not), or null for rows that pass."""
    out = F.lit(None).cast("string")
    for name, keep in reversed(stages.items()):
        out = F.when(~F.coalesce(keep, F.lit(False)), name).otherwise(out)
    return df.withColumn("dropped_by", out)


def funnel_counts(labelled: DataFrame) -> DataFrame:
    """Rows that each stage removed and rows that passed, from one pass."""
    return labelled.groupBy(F.coalesce("dropped_by", F.lit("passed")).alias("stage")).agg(F.count("*").alias("n"))


def latest_review(reviews: DataFrame, key: str, updated: str, row_id: str) -> DataFrame:
    at = Window.partitionBy(key).orderBy(F.desc_nulls_last(updated), F.desc(row_id))
    return reviews.withColumn("__n", F.row_number().over(at)).where("__n = 1").drop("__n")


def queue(df: DataFrame, order: list[Column], top: int, number: int = 1, size: int | None = None) -> DataFrame:
    """The first ``top`` rows in a total order with queue_rank, or page ``number`` of them.

    Only the top rows meet in one task: Spark takes the best of each partition before the ranks are given.
    """
    best = df.orderBy(*order).limit(top)
    ranked = best.withColumn("queue_rank", F.row_number().over(Window.orderBy(*order)))
    if size is None:
        return ranked
    return ranked.where(F.col("queue_rank").between((number - 1) * size + 1, number * size))


def with_pages(page: DataFrame, rows: DataFrame, size: int, top: int | None = None) -> DataFrame:
    """A page with ``n_total``, the rows that all pages have (``top`` at most), and ``n_pages``; a page without rows stays empty."""
    n = rows.agg(F.count("*").alias("n")).scalar()
    total = F.least(n, F.lit(top)) if top else n
    return page.withColumn("n_total", total.cast("long")).withColumn("n_pages", F.ceil(F.col("n_total") / size).cast("long"))


def formula_safe(df: DataFrame) -> DataFrame:
    """Text columns for a spreadsheet: null '', booleans true/false, and a quote before text that would start a formula."""
    def safe(name: str, kind: str) -> Column:
        c = F.coalesce(F.col(name).cast("string"), F.lit(""))
        return (F.when(F.regexp_replace(c, r"^\s+", "").rlike("^[=+@-]"), F.concat(F.lit("'"), c)).otherwise(c) if kind == "string" else c).alias(name)

    return df.select(*[safe(n, k) for n, k in df.dtypes])


def outcomes(cases: DataFrame, by: list[str], dispositions: list[str], false_positive: str = "false_positive", distinct: str | None = None) -> DataFrame:
    """For each group of reviewed cases: n, false positives, their rate, median score and a count for each disposition.

    Reviewed cases are resolved or closed with a disposition; ``distinct`` counts ids once.
    """
    rows = cases.where(F.col("status").isin(REVIEWED) & F.col("disposition").isNotNull())
    kinds = [false_positive, *[d for d in dispositions if d != false_positive]]
    if distinct is None:
        one = lambda cond: F.when(cond, 1).otherwise(0)
        sums = {"cases": F.lit(1)} | {f"n_{d}": one(F.col("disposition") == d) for d in kinds}
        found = order_statistics(rows, by, "score", {"median": MEDIAN}, sums)
    else:
        count = lambda cond: F.countDistinct(F.when(cond, F.col(distinct)))
        ids = rows.groupBy(*by).agg(count(F.lit(True)).alias("cases"), *[count(F.col("disposition") == d).alias(f"n_{d}") for d in kinds])
        middle = order_statistics(rows, by, "score", {"median": MEDIAN}).select(*[F.col(c).alias(f"__{c}") for c in by], "median")
        found = ids.join(middle, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]))
    return found.select(
        *by, F.col("cases").alias("n"), F.col(f"n_{false_positive}").alias("n_false"), F.round(F.col(f"n_{false_positive}") / F.col("cases"), 4).alias("false_rate"),
        F.round("median", 4).alias("median_score"), *[f"n_{d}" for d in kinds[1:]],
    )


def tuning(by_reason: DataFrame, least: int = 2, tighten: float = 0.5, exclude: float = 0.75, confirmed: str = "n_confirmed") -> DataFrame:
    """Advice for each reason: exclude where the false rate is high and nothing was confirmed, else tighten."""
    rate = F.col("false_rate")
    advice = F.when((rate >= exclude) & (F.col(confirmed) == 0), "exclusion_candidate").when(rate >= tighten, "tighten")
    return by_reason.where((F.col("n") >= least) & (rate >= tighten)).withColumn("advice", advice)


def nested_breakdown(rows: DataFrame, by: str, inner: str, signature: str) -> DataFrame:
    """For each ``by``: its distinct signatures sorted, and an array of (inner, n) sorted, from pre-aggregated counts."""
    counts = rows.groupBy(by, inner).agg(F.count("*").alias("n"), F.collect_set(signature).alias("s"))
    return counts.groupBy(by).agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("s")))), "|").alias("signatures"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(inner, "n"))), lambda x: F.concat(x[inner], F.lit("="), x["n"].cast("string"))), "|").alias("breakdown"),
    )


def threshold_sweep(scores: DataFrame, pairs: DataFrame, by: list[str], score: str = "score") -> DataFrame:
    """Counts of high, medium and low for each (high_cut, medium_cut) pair: rows are bucketed once, then meet the few pairs.

    The score is counted by value first, so the pairs multiply distinct scores and not rows.
    """
    counts = scores.groupBy(*by, score).agg(F.count("*").alias("__n"))
    both = counts.crossJoin(F.broadcast(pairs))  # a short list of cut-offs
    s, n = F.col(score), F.col("__n")
    zero = F.lit(0)
    return both.groupBy("high_cut", "medium_cut", *by).agg(
        F.sum(F.when(s >= F.col("high_cut"), n).otherwise(zero)).alias("n_high"),
        F.sum(F.when((s < F.col("high_cut")) & (s >= F.col("medium_cut")), n).otherwise(zero)).alias("n_medium"),
        F.sum(F.when(s < F.col("medium_cut"), n).otherwise(zero)).alias("n_low"),
    )


def histogram(scores: DataFrame, score: str = "score", width: int = 10, top: int = 100) -> DataFrame:
    """Ten buckets of equal width; the top score falls into the last."""
    bucket = F.least(F.floor(F.col(score) / width), F.lit(top // width - 1)) * width
    return scores.groupBy(bucket.cast("int").alias("bucket")).agg(F.count("*").alias("n"))


def borderline(scores: DataFrame, cuts: list[float], window: float, order: list[Column], top: int = 250, score: str = "score") -> DataFrame:
    """The rows nearest to a cut-off, within a window, nearest first."""
    away = F.least(*[F.abs(F.col(score) - c) for c in cuts]) if len(cuts) > 1 else F.abs(F.col(score) - cuts[0])
    return scores.withColumn("distance", F.round(away, 4)).where(F.col("distance") <= window).orderBy("distance", *order).limit(top)


def benchmark_mix(rows: DataFrame, by: list[str], bands: list[str], dispositions: list[str]) -> DataFrame:
    """Coverage, band mix and disposition mix of queue rows; dispositions are shares of the reviewed, unreviewed of all."""
    reviewed = F.col("disposition").isNotNull() | F.col("status").isin(REVIEWED)
    n, r = F.count("*"), F.count_if(reviewed)
    return rows.groupBy(*by).agg(
        n.alias("queue_count"), r.alias("reviewed_count"), F.round(r / n, 4).alias("review_rate"),
        *[F.round(F.count_if(F.col("band") == b) / n, 4).alias(f"band_{b}_rate") for b in bands],
        *[F.round(F.try_divide(F.count_if(F.col("disposition") == d), r), 4).alias(f"{d}_rate") for d in dispositions],
        F.round(F.count_if(~reviewed) / n, 4).alias("unreviewed_rate"),
    )


def validate_actions(actions: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """actions(key, next_status, disposition, evidence) on states(key, status, old_disposition) with ``error`` and new values.

    Errors in order: not_found, invalid_transition, invalid_disposition_for_status (one is needed exactly for resolved and
    closed), evidence_link_required.  Going back to pending or in_review clears the disposition.  An action that changes
    nothing is accepted as no_op.
    """
    both = actions.join(states, key, "left")
    now, then = F.col("status"), F.col("next_status")
    changed = now != then
    legal = F.lit(False)
    for a, b in TRANSITIONS:
        legal = legal | ((now == a) & (then == b))
    asked = F.coalesce("disposition", "old_disposition")
    kept = F.when(changed & then.isin("pending", "in_review"), F.lit(None)).otherwise(asked)
    done = then.isin(REVIEWED)
    error = (
        F.when(now.isNull(), "not_found")
        .when(changed & ~legal, "invalid_transition")
        .when(done != kept.isNotNull(), "invalid_disposition_for_status")
        .when(done & ~F.coalesce(F.col("evidence"), F.lit(False)), "evidence_link_required")
    )
    same = ~changed & kept.eqNullSafe(F.col("old_disposition"))
    return both.withColumns({"error": error, "new_disposition": F.when(error.isNull(), kept), "outcome": F.when(error.isNotNull(), "rejected").when(same, "no_op").otherwise("accepted")})
