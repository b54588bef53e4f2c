"""Rule scoring: a table of tiers turns features into triggers, scores, bands and flag rows."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotlens.operators.features import rounded


@dataclass(frozen=True)
class Rule:
    """``tiers``: (threshold, weight) from the strongest; a rule fires with its first tier that holds, always for one reason.

    ``metric`` is compared by ``op``; ``needs`` are the inputs without which the rule is skipped; ``guard`` is a SQL
    predicate that must hold as well; ``also`` are thresholds of a second metric (name, op, one value a tier).  ``says``
    explains a hit, with {value}, {threshold} and {support} for their texts.
    """

    name: str
    reason: str
    metric: str
    op: str
    tiers: tuple[tuple[float, float], ...]
    needs: tuple[str, ...] = ()
    guard: str = "true"
    also: tuple[str, str, tuple[float, ...]] | None = None
    says: str = "{value} against {threshold}"


#: The reason codes, thresholds, weights and explanations of the first rule set, and what a permit must explain.
PERMIT_SUPPORT = 10000
RULES = (
    Rule("ratio", "ratio__assessment_to_sale_below_floor", "assessment_to_sale_ratio", "<", ((0.55, 35), (0.70, 20)), says="Assessment-to-sale ratio {value} is below threshold {threshold}."),
    Rule("peer", "peer__assessment_ratio_bottom_peer_percentile", "peer_percentile", "<=", ((0.05, 20), (0.10, 12)), says="Peer percentile {value} is at or below threshold {threshold} for the parcel peer group."),
    Rule("permit_gap", "permit_gap__assessment_increase_unexplained_by_permits", "permit_adjusted_gap", ">=", ((50000, 20), (20000, 12)), says="Permit-adjusted gap {value} exceeds threshold {threshold}, indicating unexplained assessed-value increase."),
    Rule(
        "yoy", "yoy__assessment_spike_without_support", "yoy_assessment_change_pct", ">=", ((0.35, 16), (0.20, 10)),
        guard=f"permit_adjusted_expected_change is null or permit_adjusted_expected_change <= {PERMIT_SUPPORT}", says="Year-over-year assessment change {value} exceeds threshold {threshold} without strong permit support ({support} vs cutoff 10000).",
    ),
    Rule(
        "appeals", "appeal__recurring_successful_reductions", "appeal_success_rate_3y", ">=", ((0.75, 12), (0.60, 8)), needs=("appeal_value_delta_3y",), also=("appeal_value_delta_3y", "<=", (-15000, -5000)),
        says="Appeal success rate {value} meets threshold {threshold} with net negative appeal value change over 3 years.",
    ),
    Rule("lineage", "lineage__post_lineage_value_drop", "lineage_value_reset_delta", "<=", ((-100000, 18), (-50000, 10)), says="Lineage reset delta {value} is at or below threshold {threshold}, indicating a post-lineage value drop."),
)
#: The digits of metrics in texts.
DIGITS = {
    "assessment_to_sale_ratio": 6, "peer_percentile": 4, "yoy_assessment_change_pct": 6, "permit_adjusted_expected_change": 2, "permit_adjusted_gap": 2, "appeal_value_delta_3y": 2, "appeal_success_rate_3y": 4, "lineage_value_reset_delta": 2,
}

_OPS = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


def _trigger(rule: Rule) -> Column:
    metric = F.col(rule.metric).cast("double")
    out = F.lit(None)
    for i in reversed(range(len(rule.tiers))):
        limit, weight = rule.tiers[i]
        hit = _OPS[rule.op](metric, F.lit(float(limit))) & F.expr(rule.guard)
        if rule.also:
            hit = hit & _OPS[rule.also[1]](F.col(rule.also[0]).cast("double"), F.lit(float(rule.also[2][i])))
        fired = F.struct(
            F.lit(rule.name).alias("rule"), F.lit(rule.reason).alias("reason"), F.lit(float(weight)).alias("weight"), F.lit(rule.metric).alias("metric"),
            metric.alias("value"), F.lit(float(limit)).alias("threshold"), F.lit(rule.op).alias("operator"),
        )
        out = F.when(hit, fired).otherwise(out)
    return out


def _skip(rule: Rule) -> Column:
    needed = sorted({rule.metric, *rule.needs})
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in needed]))
    return F.when(F.size(missing) > 0, F.struct(F.lit(rule.name).alias("rule"), missing.alias("missing")))


def score(features: DataFrame, rules: tuple[Rule, ...] = RULES, high: float = 70, medium: float = 40) -> DataFrame:
    """features with triggers (weight descending, reason), skipped, raw_score, score (at most 100), band, requires_review."""
    triggers = F.array_compact(F.array(*[_trigger(r) for r in rules]))
    triggers = F.array_sort(triggers, lambda a, b: F.when(a["weight"] > b["weight"], -1).when(a["weight"] < b["weight"], 1).when(a["reason"] < b["reason"], -1).when(a["reason"] > b["reason"], 1).otherwise(0))
    out = features.withColumns({"triggers": triggers, "skipped": F.array_compact(F.array(*[_skip(r) for r in rules]))})
    raw = F.aggregate("triggers", F.lit(0.0), lambda acc, t: acc + t["weight"])
    out = out.withColumn("raw_score", F.round(raw, 2)).withColumn("score", F.least(F.lit(100.0), F.col("raw_score")))
    band = F.when(F.col("score") >= high, "high").when(F.col("score") >= medium, "medium").otherwise("low")
    return out.withColumn("band", band).withColumn("requires_review", F.col("score") >= medium)


def limit_text(limit: float) -> str:
    return f"{limit:.2f}" if abs(limit) < 1 else f"{limit:.0f}"


def metric_text(name: str, value: Column | None = None) -> Column:
    digits = DIGITS.get(name, 4)
    return rounded((F.col(name) if value is None else value).cast("double"), digits).cast(f"decimal(20,{digits})").cast("string")


def _support() -> Column:
    return F.when(F.col("permit_adjusted_expected_change").isNull(), "is_null").otherwise("<=_cutoff")


def _explained(rules: tuple[Rule, ...]) -> Column:
    """The sentence of the rule of trigger ``t``."""
    limits = F.create_map(*[x for r in rules for limit, _ in r.tiers for x in (F.lit(f"{r.name} {float(limit)}"), F.lit(limit_text(limit)))])
    out = F.lit(None).cast("string")
    for r in rules:
        said = {"{value}": metric_text(r.metric, F.col("t.value")), "{threshold}": F.element_at(limits, F.concat_ws(" ", "t.rule", F.col("t.threshold").cast("string"))), "{support}": _support()}
        parts = [said.get(x, F.lit(x)) for x in re.split(r"(\{\w+\})", r.says) if x]
        out = F.when(F.col("t.rule") == r.name, F.concat(*parts)).otherwise(out)
    return out


def _evidence(rules: tuple[Rule, ...], permit_basis: str | None) -> Column:
    """What else a hit rests on, as a map of texts: the lack of permits for a rise, the value change for appeals; else null."""
    none = F.lit(None).cast("string")
    expected = "permit_adjusted_expected_change"
    yoy = F.create_map(
        F.lit(expected), metric_text(expected), F.lit(f"{expected}_condition"), _support(), F.lit(f"{expected}_cutoff"), F.lit(str(PERMIT_SUPPORT)), F.lit("permit_basis"), F.col(permit_basis) if permit_basis else none,
    )
    out = F.when(F.col("t.rule") == "yoy", yoy)
    for r in rules:
        if r.also:
            limit = F.lit(None).cast("string")
            for (first, _), second in zip(r.tiers, r.also[2], strict=True):
                limit = F.when(F.col("t.threshold") == float(first), limit_text(second)).otherwise(limit)
            out = out.when(F.col("t.rule") == r.name, F.create_map(F.lit(r.also[0]), metric_text(r.also[0]), F.lit(r.also[0].removesuffix("_3y") + "_threshold"), limit))
    return out


def flag_rows(scored: DataFrame, keys: list[str], rules: tuple[Rule, ...] = RULES, permit_basis: str | None = None) -> DataFrame:
    """One row for each trigger: keys, score, band, reason_rank, the trigger's fields, an explanation and ``evidence``.

    permit_basis: the column that says what a permit's expected change is taken from, if there is one.
    """
    more = [c for c in {"permit_adjusted_expected_change", permit_basis, *[r.also[0] for r in rules if r.also]} if c]
    rows = scored.select(*keys, "score", "band", F.posexplode("triggers").alias("pos", "t"), *[F.col(c) for c in more if c not in keys])
    return rows.select(*keys, "score", "band", (F.col("pos") + 1).alias("reason_rank"), "t.*", _explained(rules).alias("explanation"), _evidence(rules, permit_basis).alias("evidence"))


def rescore(new: DataFrame, old: DataFrame, reviewed: DataFrame, keys: list[str]) -> DataFrame:
    """new with score_id and action: rows whose old score has a review keep its id (update), others get a new one (insert).

    old: keys, score_id; reviewed: score_id.  New ids are hashes of the keys and so the same in every run.
    """
    kept = old.join(reviewed.select("score_id").distinct(), "score_id", "left_semi")
    both = new.join(kept, keys, "left")
    made = F.substring(F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), 256), 1, 16)
    return both.withColumn("action", F.when(F.col("score_id").isNotNull(), "update").otherwise("insert")).withColumn("score_id", F.coalesce(F.col("score_id").cast("string"), made))


def primary_reason(flags: DataFrame, keys: list[str]) -> DataFrame:
    return flags.where("reason_rank = 1").select(*keys, F.col("reason").alias("primary_reason"))


# Phrases of sales that do not count, in lower case.
FAMILY_PHRASES = ["family transfer", "intra family", "intrafamily"]
GOVERNMENT_PHRASES = ["government transfer", "county of ", "city of ", "village of ", "town of ", "state of ", "department of ", "school district", "united states"]
CORRECTIVE_PHRASES = ["corrective deed", "correction deed"]


def sale_exclusions(sales: DataFrame, key: str, arms_length: str, usable: str, transfer: list[str], parties: list[str]) -> DataFrame:
    """One row for each exclusion of a sale, by indicators that are false and by phrases in lower-cased texts."""
    corrective = r"(?<![a-z-])(?:" + "|".join(CORRECTIVE_PHRASES) + r")\b"
    family, government = "|".join(FAMILY_PHRASES), "|".join(GOVERNMENT_PHRASES)
    any_of = lambda cols, p: F.coalesce(F.lower(F.concat_ws("\n", *[F.regexp_replace(c, r"\s+", " ") for c in cols])).rlike(p), F.lit(False))
    checks = {
        "non_arms_length": F.col(arms_length) == F.lit(False), "non_usable_sale": F.col(usable) == F.lit(False), "family_transfer": any_of(transfer, family),
        "government_transfer": any_of([*transfer, *parties], government), "corrective_deed": any_of(transfer, corrective),
    }
    codes = F.array_compact(F.array(*[F.when(check, code) for code, check in checks.items()]))
    return sales.select(key, F.explode(codes).alias("exclusion_code"))


