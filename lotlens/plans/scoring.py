"""Queries on rule scores, the review queue, outcomes and calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.operators import features, pick, review, rules
from lotlens.plans import valuation as v
from lotlens.runtime import cut, scratch, table
from lotlens.sources import sinks

KEYS = ["parcel_id", "yr"]


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of part-years.  Lines are dealt by part once, as what is read of them and not as aggregates, which are wider; roll-ups,
    prior years and windows follow where they lie, and sort only the columns that they read.  The result is written, so that peers, sales and parents read it."""
    lines = v.dealt_events(spark, sf_dir)
    sums = lines.groupBy(*KEYS).agg(F.sum("cents").alias("v"), F.struct(*v.permit_columns()).alias("permit"), F.struct(*v.appeal_columns()).alias("appeal"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("parcel_id"), F.col("p_brand").alias("muni"), F.col("p_type").alias("cls"))

    p, a = F.col("permit"), F.col("appeal")
    expected = features.expected_permit_change(p["event_count"], p["declared_known"], p["declared_sum"], p["estimated_known"], p["estimated_sum"])["value"]
    known = F.when(a["change_known"] == a["event_count"], a["change_total"].cast("double"))
    rows = sums.select(*KEYS, "v", expected.alias("expected"), a["event_count"].alias("n"), known.alias("delta"), a["F_count"].alias("won"), a["unknown_count"].alias("vague"))
    rows = rows.withColumn("prior", pick.prior_year(["parcel_id"], "yr", "v"))
    rows = features.appeal_window(rows, ["parcel_id"], "yr", "n", "delta", "won", "vague").join(part, "parcel_id")
    gap = features.permit_gap(F.col("v").cast("double"), F.col("prior").cast("double"), F.col("expected"))
    done = [
        features.change_pct(F.col("v"), F.col("prior")).alias("yoy_assessment_change_pct"), F.col("expected").alias("permit_adjusted_expected_change"), F.round(gap, 2).alias("permit_adjusted_gap"),
        F.round("appeal_delta", 2).alias("appeal_value_delta_3y"), F.col("appeal_rate").alias("appeal_success_rate_3y"),
    ]
    rows = cut(rows.select(*KEYS, "muni", "cls", "v", *done), "zstd")
    own = rows.columns[len(KEYS) + 3 :]
    rows = features.lineage_reset(rows, v.lineage_edges(spark, sf_dir), rows.select(*KEYS, "v"))
    rows = v.with_sale_ratio(rows, v.selected_sale(spark, sf_dir)).select(*KEYS, "muni", "cls", *own, F.round("reset", 2).alias("lineage_value_reset_delta"), F.col("ratio").alias("assessment_to_sale_ratio"))
    rows = pick.mid_rank_percentile(rows, v.GROUPS, "assessment_to_sale_ratio", "peer_percentile")
    return rows.select(*KEYS, "muni", "cls", "assessment_to_sale_ratio", "peer_percentile", *own, "lineage_value_reset_delta")


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.score(_features(spark, sf_dir))


def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    reasons = F.array_join(F.transform("triggers", lambda t: t["reason"]), ",").alias("reasons")
    return _scored(spark, sf_dir).select(*KEYS, "raw_score", "score", "band", "requires_review", reasons, F.size("skipped").alias("n_skipped"))


def rule_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.flag_rows(_scored(spark, sf_dir), KEYS).select(*KEYS, "score", "band", "reason_rank", "rule", "reason", "weight", "metric", "threshold", "operator", F.round("value", 6).alias("value"))


def flag_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each rule fired: its sentence and the secondary evidence as text."""
    flags = rules.flag_rows(_scored(spark, sf_dir), KEYS)
    text = F.array_join(F.transform(F.array_sort(F.map_entries("evidence")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("-")))), ",")
    return flags.select(*KEYS, "reason", "reason_rank", "explanation", text.alias("evidence"))


def review_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, name): the band of each row that needs review, and each reason of rows whose band is not low; one pass over the scores."""
    entry = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    reasons = F.when(F.col("band") != "low", F.transform("triggers", lambda t: entry("reason", t["reason"])))
    band = F.when(F.col("requires_review"), F.array(entry("band", F.col("band"))))
    none = F.array().cast("array<struct<kind: string, name: string>>")
    return _scored(spark, sf_dir).select(F.inline(F.concat(F.coalesce(reasons, none), F.coalesce(band, none))))


def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir).select(F.explode("skipped").alias("s")).select("s.rule", F.array_join("s.missing", ",").alias("missing"))
    return rows.groupBy("rule", "missing").agg(F.count("*").alias("n"))


def primary_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.primary_reason(rules.flag_rows(_scored(spark, sf_dir), KEYS), KEYS)


def top_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_flags(spark, sf_dir).orderBy(F.desc("score"), "reason_rank", "parcel_id", "yr", "reason").limit(20).select(*KEYS, "score", "reason_rank", "reason")


def top_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir).select(*KEYS, "score", F.size("triggers").alias("reason_count"))
    return rows.orderBy(F.desc("score"), F.desc("reason_count"), "parcel_id", "yr").limit(20)


def band_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).groupBy("band").agg(F.count("*").alias("n"), F.count_if("requires_review").alias("n_review"), F.sum(F.size("triggers")).alias("n_flags"))


def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = rules.flag_rows(_scored(spark, sf_dir), KEYS)
    return flags.groupBy("reason", "band").agg(F.count("*").alias("n"), F.countDistinct(*KEYS).alias("n_rows"))


def rescored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old scores of parts before 1999; those with a high enough score were reviewed and keep their ids."""
    now = cut(rule_scores(spark, sf_dir).select(*KEYS, "score"))  # read three times below
    old = now.where("yr < 1999").select(*KEYS, F.concat_ws("-", F.lit("old"), "parcel_id", "yr").alias("score_id"), "score")
    reviewed = old.where("score >= 40").select("score_id")
    return rules.rescore(now, old.select(*KEYS, "score_id"), reviewed, KEYS).select(*KEYS, "score", "action", "score_id")


def sale_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    rows = orders.join(customer, "o_custkey").select(
        "o_orderkey", (F.col("o_orderstatus") != "P").alias("arms"), F.when(F.col("o_totalprice") > 1000, F.col("o_orderpriority") != "5-LOW").alias("usable"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Corrective  Deed").when(F.col("o_orderpriority") == "2-HIGH", "non-corrective deed").otherwise("Family Transfer").alias("deed"),
        F.concat(F.when(F.col("c_mktsegment") == "BUILDING", "City of ").otherwise("The "), F.col("c_name")).alias("party"),
    )
    return rules.sale_exclusions(rows, "o_orderkey", "arms", "usable", ["deed"], ["party"])


def filter_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir)
    stages = {
        "parcel": F.col("muni").isNotNull(), "year": F.col("yr").between(1996, 2000), "band": F.col("band").isin("high", "medium"), "requires_review": F.col("requires_review"),
        "reason": F.exists("triggers", lambda t: t["rule"] != "yoy"),
    }
    return review.funnel_counts(review.funnel(rows, stages))


def review_queue_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir).select(*KEYS, "muni", "score", "band", F.size("triggers").alias("reason_count"))
    order = [F.desc("score"), F.desc("reason_count"), F.desc("yr"), F.asc("parcel_id")]
    return review.with_pages(review.queue(rows, order, 60, number=2, size=25), rows, 25, 60)


def queue_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thousand highest rows of two runs as CSV, the second written twice, the last time with its best hundred; all read back."""
    scored = _scored(spark, sf_dir)
    first = F.try_element_at("triggers", F.lit(1))
    own = [F.desc("score"), F.desc("reason_code_count"), F.desc("yr"), F.asc("parcel_id")]
    rows = scored.select(*KEYS, "score", "band", "requires_review", "muni", "cls", F.size("triggers").alias("reason_code_count"), first["reason"].alias("reason"), first["weight"].alias("weight"))
    top = cut(review.queue(rows, own, 1000))
    none = F.lit(None).cast("string")
    text = F.concat(F.when(F.col("cls").startswith("S"), " =").when(F.col("cls").startswith("P"), 'say "a, b"\n').otherwise(""), F.col("muni"))

    def run(name: str, most: int) -> DataFrame:
        return top.where(F.col("queue_rank") <= most).select(
            "queue_rank", F.concat_ws("-", "parcel_id", "yr").alias("score_id"), F.lit(name).alias("run_id"), none.alias("feature_run_id"), "parcel_id", F.col("yr").alias("year"), F.col("score").cast("decimal(6,2)").alias("score_value"),
            F.col("band").alias("risk_band"), "requires_review", F.lit("unreviewed").alias("review_status"), none.alias("review_disposition"), none.alias("review_updated_at"), "reason_code_count", F.col("reason").alias("primary_reason_code"),
            F.col("weight").cast("decimal(6,2)").alias("primary_reason_weight"), text.alias("municipality_name"), F.when(F.col("score") > 45, F.concat(F.col("cls"), F.lit(" "))).alias("valuation_classification"), F.col("parcel_id").alias("dossier_parcel_id"),
            F.col("yr").alias("dossier_year"), F.lit("-v1").alias("dossier_feature_version"), F.lit("").alias("dossier_ruleset_version"),
        )

    folder = scratch(spark, "queue")
    for name, most in (("run a", 1000), ("run b", 500), ("run b", 100)):
        sinks.write_queue(run(name, most), folder)
    return sinks.read_queue(spark, folder)


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    rows = table(spark, sf_dir, "labels").join(docs, "doc_id")
    rows = rows.withColumn("score", F.least(F.lit(100.0), F.floor(F.col("n_chars") / 4) / 10.0))
    return rows.select(
        "doc_id", "score", F.when(F.col("score") >= 70, "high").when(F.col("score") >= 40, "medium").otherwise("low").alias("band"),
        F.when(F.col("lang") == "en", "resolved").when(F.col("lang") == "de", "closed").otherwise("open").alias("status"),
        F.when(F.col("toxic") == 1, "confirmed").when(F.col("quality") == 0, "false_positive").when(F.col("n_chars") > 60, "inconclusive").alias("disposition"),
        "lang", "source",
    )


_DISPOSITIONS = ["confirmed", "false_positive", "inconclusive"]


def _reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _cases(spark, sf_dir).withColumn("reason", F.explode(F.array("source", F.concat(F.lit("lang_"), "lang"))))
    return rows.withColumn("signature", F.concat("reason", F.when(F.col("score") > 50, ">50").otherwise("<=50")))


def band_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.outcomes(_cases(spark, sf_dir), ["band"], _DISPOSITIONS)


def reason_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.outcomes(_reasons(spark, sf_dir), ["reason"], _DISPOSITIONS)


def reason_band_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.outcomes(_reasons(spark, sf_dir), ["reason", "band"], _DISPOSITIONS, distinct="doc_id")


def reason_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.nested_breakdown(_reasons(spark, sf_dir), "reason", "band", "signature")


def tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.tuning(reason_outcomes(spark, sf_dir), tighten=0.1, exclude=0.2)


def benchmark_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of the 200 highest scores."""
    top = _cases(spark, sf_dir).orderBy(F.desc("score"), "doc_id").limit(200)
    return review.benchmark_mix(top, [], ["high", "medium"], _DISPOSITIONS)


def benchmark_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.benchmark_mix(_cases(spark, sf_dir), ["lang", "source"], ["high", "medium"], _DISPOSITIONS)


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.round(F.least(F.lit(100.0), F.col("o_totalprice") / 5000), 2).alias("score"))


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spark.range(12).select((F.floor(F.col("id") / 3) * 5 + 60).alias("high_cut"), (F.col("id") % 3 * 5 + 30).alias("medium_cut"))
    return review.threshold_sweep(_scores(spark, sf_dir), pairs, ["o_orderpriority"])


def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.histogram(_scores(spark, sf_dir))


def reason_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scores(spark, sf_dir).withColumn("band", F.when(F.col("score") >= 70, "high").when(F.col("score") >= 40, "medium").otherwise("low"))
    return rows.groupBy("band", F.col("o_orderpriority").alias("reason")).agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("n_parties"))


def borderline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.borderline(_scores(spark, sf_dir), [70.0, 40.0], 2.0, [F.asc("o_orderkey")]).select("o_orderkey", "score", "distance")


def area_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = _scores(spark, sf_dir).join(customer, "o_custkey").join(nation, "n_nationkey")
    out = rows.groupBy("n_name").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("avg_score"), F.round(F.count_if(F.col("score") >= 40) / F.count("*") * 100, 4).alias("queue_pct"))
    return out.where("n >= 5")


def run_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs (event types) with a value from their JSON settings and the number of errors of their users."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    errors = events.where("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("n_errors"))
    rows = events.where("event_type <> 'error'").groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.max(k).alias("max_k"))
    return rows.join(errors, "user_id", "left").select("event_type", "user_id", "n", "max_k", "n_errors")


def _actions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    first = events.groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("e"))
    state = F.when(F.col("e") == "view", "pending").when(F.col("e") == "click", "in_review").when(F.col("e") == "purchase", "resolved").otherwise("closed")
    states = first.where("e <> 'error'").select("user_id", state.alias("status")).withColumn("old_disposition", F.when(F.col("status").isin("resolved", "closed"), "confirmed"))
    then = F.when(F.col("event_type") == "view", "pending").when(F.col("event_type") == "click", "in_review").when(F.col("event_type") == "purchase", "resolved").otherwise("closed")
    actions = events.select("event_id", "user_id", then.alias("next_status"), F.when(F.col("value") > 30, "false_positive").alias("disposition"), (F.col("value") > 20).alias("evidence"))
    return actions, states


def review_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.validate_actions(*_actions(spark, sf_dir), "user_id").select("event_id", "error", "outcome", "new_disposition")


_FEAT = f"""with peer as ({v.SQL["peer_percentile"]}), yoy as ({v.SQL["yoy_change"]}), exp as ({v.SQL["permit_expected_change"]}),
app as ({v.SQL["appeal_window_3y"]}), lin as ({v.SQL["lineage_reset"]}),
feat as (
  select p.parcel_id, p.yr, p.muni, p.cls, p.ratio as assessment_to_sale_ratio, p.percentile as peer_percentile, y.change as yoy_assessment_change_pct,
         e.expected as permit_adjusted_expected_change, e.gap as permit_adjusted_gap, a.appeal_delta as appeal_value_delta_3y,
         a.appeal_rate as appeal_success_rate_3y, l.reset as lineage_value_reset_delta
  from peer p left join yoy y using (parcel_id, yr) left join exp e using (parcel_id, yr) left join app a using (parcel_id, yr) left join lin l using (parcel_id, yr)),
flag0 as (
  select parcel_id, yr, 'ratio' as rule, 'ratio__assessment_to_sale_below_floor' as reason,
         case when assessment_to_sale_ratio < 0.55 then 35.0 else 20.0 end as weight, 'assessment_to_sale_ratio' as metric, assessment_to_sale_ratio as value,
         case when assessment_to_sale_ratio < 0.55 then 0.55 else 0.7 end as threshold, '<' as operator from feat where assessment_to_sale_ratio < 0.7
  union all
  select parcel_id, yr, 'peer', 'peer__assessment_ratio_bottom_peer_percentile', case when peer_percentile <= 0.05 then 20 else 12 end,
         'peer_percentile', peer_percentile, case when peer_percentile <= 0.05 then 0.05 else 0.1 end, '<=' from feat where peer_percentile <= 0.1
  union all
  select parcel_id, yr, 'permit_gap', 'permit_gap__assessment_increase_unexplained_by_permits', case when permit_adjusted_gap >= 50000 then 20 else 12 end,
         'permit_adjusted_gap', permit_adjusted_gap, case when permit_adjusted_gap >= 50000 then 50000 else 20000 end, '>=' from feat where permit_adjusted_gap >= 20000
  union all
  select parcel_id, yr, 'yoy', 'yoy__assessment_spike_without_support', case when yoy_assessment_change_pct >= 0.35 then 16 else 10 end,
         'yoy_assessment_change_pct', yoy_assessment_change_pct, case when yoy_assessment_change_pct >= 0.35 then 0.35 else 0.2 end, '>='
  from feat where yoy_assessment_change_pct >= 0.2 and (permit_adjusted_expected_change is null or permit_adjusted_expected_change <= 10000)
  union all
  select parcel_id, yr, 'appeals', 'appeal__recurring_successful_reductions',
         case when appeal_success_rate_3y >= 0.75 and appeal_value_delta_3y <= -15000 then 12 else 8 end, 'appeal_success_rate_3y', appeal_success_rate_3y,
         case when appeal_success_rate_3y >= 0.75 and appeal_value_delta_3y <= -15000 then 0.75 else 0.6 end, '>='
  from feat where appeal_success_rate_3y >= 0.6 and appeal_value_delta_3y <= -5000
  union all
  select parcel_id, yr, 'lineage', 'lineage__post_lineage_value_drop', case when lineage_value_reset_delta <= -100000 then 18 else 10 end,
         'lineage_value_reset_delta', lineage_value_reset_delta, case when lineage_value_reset_delta <= -100000 then -100000 else -50000 end, '<='
  from feat where lineage_value_reset_delta <= -50000),
skip0 as (
  select parcel_id, yr, 'ratio' as rule, 'assessment_to_sale_ratio' as missing from feat where assessment_to_sale_ratio is null
  union all select parcel_id, yr, 'peer', 'peer_percentile' from feat where peer_percentile is null
  union all select parcel_id, yr, 'permit_gap', 'permit_adjusted_gap' from feat where permit_adjusted_gap is null
  union all select parcel_id, yr, 'yoy', 'yoy_assessment_change_pct' from feat where yoy_assessment_change_pct is null
  union all select parcel_id, yr, 'appeals', concat_ws(',', case when appeal_success_rate_3y is null then 'appeal_success_rate_3y' end, case when appeal_value_delta_3y is null then 'appeal_value_delta_3y' end)
            from feat where appeal_success_rate_3y is null or appeal_value_delta_3y is null
  union all select parcel_id, yr, 'lineage', 'lineage_value_reset_delta' from feat where lineage_value_reset_delta is null),
total as (select parcel_id, yr, sum(weight) as raw, count(*) as n, string_agg(reason, ',' order by weight desc, reason) as reasons, bool_or(rule <> 'yoy') as other from flag0 group by all),
skipped as (select parcel_id, yr, count(*) as n from skip0 group by all),
scored as (
  select f.*, cast(round(coalesce(raw, 0), 2) as double) as raw_score, cast(least(100, round(coalesce(raw, 0), 2)) as double) as score, coalesce(t.n, 0) as reason_count,
         coalesce(reasons, '') as reasons, coalesce(s.n, 0) as n_skipped, coalesce(other, false) as other
  from feat f left join total t using (parcel_id, yr) left join skipped s using (parcel_id, yr)),
banded as (select *, case when score >= 70 then 'high' when score >= 40 then 'medium' else 'low' end as band, score >= 40 as requires_review from scored),
flags as (
  select g.*, b.score, b.band, row_number() over (partition by g.parcel_id, g.yr order by g.weight desc, g.reason) as reason_rank
  from flag0 g join banded b using (parcel_id, yr))
"""

_CASES = """with cases as (
  select *, case when score >= 70 then 'high' when score >= 40 then 'medium' else 'low' end as band from (
    select l.doc_id, least(100.0, floor(n_chars / 4) / 10.0) as score, case lang when 'en' then 'resolved' when 'de' then 'closed' else 'open' end as status,
           case when toxic = 1 then 'confirmed' when quality = 0 then 'false_positive' when n_chars > 60 then 'inconclusive' end as disposition, lang, source
    from labels l join documents d on d.doc_id = l.doc_id)),
reason0 as (select *, source as reason from cases union all select *, 'lang_' || lang from cases),
reasons as (select *, reason || case when score > 50 then '>50' else '<=50' end as signature from reason0)
"""


def _outcome_sql(source: str, by: str, n: str = "count(*)", one: str = "count(*) filter (where {})") -> str:
    false = one.format("disposition = 'false_positive'")
    return f"""select {by}, {n} as n, {false} as n_false, round({false} / {n}, 4) as false_rate, round(median(cast(score as double)), 4) as median_score,
       {one.format("disposition = 'confirmed'")} as n_confirmed, {one.format("disposition = 'inconclusive'")} as n_inconclusive
from {source} where status in ('resolved', 'closed') and disposition is not null group by {by}"""


_MIX = """count(*) as queue_count, count(*) filter (where rev) as reviewed_count, round(count(*) filter (where rev) / count(*), 4) as review_rate,
       round(count(*) filter (where band = 'high') / count(*), 4) as band_high_rate, round(count(*) filter (where band = 'medium') / count(*), 4) as band_medium_rate,
       round(count(*) filter (where disposition = 'confirmed') / nullif(count(*) filter (where rev), 0), 4) as confirmed_rate,
       round(count(*) filter (where disposition = 'false_positive') / nullif(count(*) filter (where rev), 0), 4) as false_positive_rate,
       round(count(*) filter (where disposition = 'inconclusive') / nullif(count(*) filter (where rev), 0), 4) as inconclusive_rate,
       round(count(*) filter (where not rev) / count(*), 4) as unreviewed_rate
from (select *, disposition is not null or status in ('resolved', 'closed') as rev from {})"""

_SCORES = "with scores as (select o_orderkey, o_custkey, o_orderpriority, round(least(100.0, o_totalprice / 5000), 2) as score from orders)\n"

QUERIES = {f.__name__: f for f in (
    feature_rows, rule_scores, rule_flags, flag_evidence, skip_reasons, primary_reasons, top_flags, top_parcels, band_breakdown, reason_counts, rescored_ids, sale_exclusions,
    filter_funnel, review_queue_page, queue_csv, band_outcomes, reason_outcomes, reason_band_slices, reason_breakdown, tuning, benchmark_mix, benchmark_segments,
    threshold_sweep, score_histogram, reason_mix, borderline, area_rollup, run_inventory, review_actions,
)}

SQL = {
    "feature_rows": _FEAT + "select * from feat",
    "rule_scores": _FEAT + "select parcel_id, yr, raw_score, score, band, requires_review, reasons, n_skipped from banded",
    "rule_flags": _FEAT + "select parcel_id, yr, score, band, reason_rank, rule, reason, cast(weight as double) as weight, metric, cast(threshold as double) as threshold, operator, round(value, 6) as value from flags",
    "flag_evidence": _FEAT + """select g.parcel_id, g.yr, reason, reason_rank, case rule
         when 'ratio' then 'Assessment-to-sale ratio ' || cast(cast(value as decimal(20,6)) as varchar) || ' is below threshold ' || case when weight = 35 then '0.55' else '0.70' end || '.'
         when 'peer' then 'Peer percentile ' || cast(cast(value as decimal(20,4)) as varchar) || ' is at or below threshold ' || case when weight = 20 then '0.05' else '0.10' end || ' for the parcel peer group.'
         when 'permit_gap' then 'Permit-adjusted gap ' || cast(cast(value as decimal(20,2)) as varchar) || ' exceeds threshold ' || case when weight = 20 then '50000' else '20000' end || ', indicating unexplained assessed-value increase.'
         when 'yoy' then 'Year-over-year assessment change ' || cast(cast(value as decimal(20,6)) as varchar) || ' exceeds threshold ' || case when weight = 16 then '0.35' else '0.20' end || ' without strong permit support (' || support || ' vs cutoff 10000).'
         when 'appeals' then 'Appeal success rate ' || cast(cast(value as decimal(20,4)) as varchar) || ' meets threshold ' || case when weight = 12 then '0.75' else '0.60' end || ' with net negative appeal value change over 3 years.'
         else 'Lineage reset delta ' || cast(cast(value as decimal(20,2)) as varchar) || ' is at or below threshold ' || case when weight = 18 then '-100000' else '-50000' end || ', indicating a post-lineage value drop.' end as explanation,
       case rule when 'yoy' then 'permit_adjusted_expected_change=' || coalesce(cast(cast(permit_adjusted_expected_change as decimal(20,2)) as varchar), '-') || ',permit_adjusted_expected_change_condition=' || support || ',permit_adjusted_expected_change_cutoff=10000,permit_basis=-'
         when 'appeals' then 'appeal_value_delta_3y=' || cast(cast(appeal_value_delta_3y as decimal(20,2)) as varchar) || ',appeal_value_delta_threshold=' || case when weight = 12 then '-15000' else '-5000' end end as evidence
from flags g join (select *, case when permit_adjusted_expected_change is null then 'is_null' else '<=_cutoff' end as support from feat) f on f.parcel_id = g.parcel_id and f.yr = g.yr""",
    "skip_reasons": _FEAT + "select rule, missing, count(*) as n from skip0 group by all",
    "primary_reasons": _FEAT + "select parcel_id, yr, reason as primary_reason from flags where reason_rank = 1",
    "top_flags": _FEAT + "select parcel_id, yr, score, reason_rank, reason from flags order by score desc, reason_rank, parcel_id, yr, reason limit 20",
    "top_parcels": _FEAT + "select parcel_id, yr, score, reason_count from banded order by score desc, reason_count desc, parcel_id, yr limit 20",
    "band_breakdown": _FEAT + "select band, count(*) as n, count(*) filter (where requires_review) as n_review, cast(sum(reason_count) as bigint) as n_flags from banded group by all",
    "reason_counts": _FEAT + "select reason, band, count(*) as n, count(distinct (parcel_id, yr)) as n_rows from flags group by all",
    "rescored_ids": _FEAT + """select parcel_id, yr, score, case when yr < 1999 and score >= 40 then 'update' else 'insert' end as action,
       case when yr < 1999 and score >= 40 then 'old-' || parcel_id || '-' || yr else substr(sha256(parcel_id || '|' || yr), 1, 16) end as score_id from banded""",
    "sale_exclusions": """with r as (
  select o_orderkey, o_orderstatus <> 'P' as arms, case when o_totalprice > 1000 then o_orderpriority <> '5-LOW' end as usable, o_orderpriority as p, c_mktsegment as m
  from orders join customer on c_custkey = o_custkey)
select o_orderkey, 'non_arms_length' as exclusion_code from r where not arms union all select o_orderkey, 'non_usable_sale' from r where not usable
union all select o_orderkey, 'corrective_deed' from r where p = '1-URGENT' union all select o_orderkey, 'family_transfer' from r where p not in ('1-URGENT', '2-HIGH')
union all select o_orderkey, 'government_transfer' from r where m = 'BUILDING'""",
    "filter_funnel": _FEAT + """select case when muni is null then 'parcel' when yr not between 1996 and 2000 then 'year' when band not in ('high', 'medium') then 'band'
       when not requires_review then 'requires_review' when not other then 'reason' else 'passed' end as stage, count(*) as n from banded group by all""",
    "review_queue_page": _FEAT + """select * from (select parcel_id, yr, muni, score, band, reason_count,
       row_number() over (order by score desc, reason_count desc, yr desc, parcel_id) as queue_rank, least(60, count(*) over ()) as n_total, cast(ceil(least(60, count(*) over ()) / 25) as bigint) as n_pages
       from banded) where queue_rank between 26 and 50""",
    "queue_csv": _FEAT + """, best as (
  select *, row_number() over (order by score desc, reason_count desc, yr desc, parcel_id) as rank from banded),
runs as (select unnest(['run a', 'run b']) as run_id, unnest([1000, 100]) as most),
f as (select parcel_id, yr, reason, weight from flags where reason_rank = 1)
select cast(rank as varchar) as queue_rank, b.parcel_id || '-' || b.yr as score_id, run_id, '' as feature_run_id, cast(b.parcel_id as varchar) as parcel_id, cast(b.yr as varchar) as year, cast(cast(score as decimal(6,2)) as varchar) as score_value,
       band as risk_band, cast(requires_review as varchar) as requires_review, 'unreviewed' as review_status, '' as review_disposition, '' as review_updated_at, cast(reason_count as varchar) as reason_code_count, coalesce(reason, '') as primary_reason_code,
       coalesce(cast(cast(weight as decimal(6,2)) as varchar), '') as primary_reason_weight, case when cls like 'S%' then '''' || ' =' || muni when cls like 'P%' then 'say "a, b"' || chr(10) || muni else muni end as municipality_name,
       case when score > 45 then cls || ' ' else '' end as valuation_classification, cast(b.parcel_id as varchar) as dossier_parcel_id, cast(b.yr as varchar) as dossier_year, '''' || '-v1' as dossier_feature_version, '' as dossier_ruleset_version
from best b join runs on rank <= most left join f on f.parcel_id = b.parcel_id and f.yr = b.yr""",
    "band_outcomes": _CASES + _outcome_sql("cases", "band"),
    "reason_outcomes": _CASES + _outcome_sql("reasons", "reason"),
    "reason_band_slices": _CASES + _outcome_sql("reasons", "reason, band", "count(distinct doc_id)", "count(distinct case when {} then doc_id end)"),
    "reason_breakdown": _CASES + """, c as (select reason, band, count(*) as n from reasons group by all), s as (select distinct reason, signature from reasons)
select reason, (select string_agg(signature, '|' order by signature) from s where s.reason = c.reason) as signatures, string_agg(band || '=' || n, '|' order by band) as breakdown from c group by reason""",
    "tuning": _CASES + f", o as ({_outcome_sql('reasons', 'reason')}) select *, case when false_rate >= 0.2 and n_confirmed = 0 then 'exclusion_candidate' else 'tighten' end as advice from o where n >= 2 and false_rate >= 0.1",
    "benchmark_mix": _CASES + ", top as (select * from cases order by score desc, doc_id limit 200) select " + _MIX.format("top"),
    "benchmark_segments": _CASES + "select lang, source, " + _MIX.format("cases") + " group by lang, source",
    "threshold_sweep": _SCORES + """select high_cut, medium_cut, o_orderpriority, count(*) filter (where score >= high_cut) as n_high,
       count(*) filter (where score < high_cut and score >= medium_cut) as n_medium, count(*) filter (where score < medium_cut) as n_low
from scores, (select unnest([60, 65, 70, 75]) as high_cut), (select unnest([30, 35, 40]) as medium_cut) group by all""",
    "score_histogram": _SCORES + "select cast(least(floor(score / 10), 9) * 10 as int) as bucket, count(*) as n from scores group by all",
    "reason_mix": _SCORES + "select case when score >= 70 then 'high' when score >= 40 then 'medium' else 'low' end as band, o_orderpriority as reason, count(*) as n, count(distinct o_custkey) as n_parties from scores group by all",
    "borderline": _SCORES + """select o_orderkey, score, round(least(abs(score - 70), abs(score - 40)), 4) as distance from scores
where round(least(abs(score - 70), abs(score - 40)), 4) <= 2 order by distance, o_orderkey limit 250""",
    "area_rollup": _SCORES + """select n_name, count(*) as n, round(avg(score), 4) as avg_score, round(count(*) filter (where score >= 40) / count(*) * 100, 4) as queue_pct
from scores join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey group by n_name having count(*) >= 5""",
    "run_inventory": """with e as (select user_id, count(*) as n_errors from events where event_type = 'error' group by all),
r as (select event_type, user_id, count(*) as n, max(cast(json_extract_string(props, '$.k') as bigint)) as max_k from events where event_type <> 'error' group by all)
select event_type, r.user_id, n, max_k, n_errors from r left join e on e.user_id = r.user_id""",
    "review_actions": """with f as (select user_id, arg_min(event_type, event_id) as e from events group by all),
st as (select user_id, case e when 'view' then 'pending' when 'click' then 'in_review' when 'purchase' then 'resolved' else 'closed' end as status from f where e <> 'error'),
s as (select *, case when status in ('resolved', 'closed') then 'confirmed' end as old_disposition from st),
a as (select event_id, user_id, case event_type when 'view' then 'pending' when 'click' then 'in_review' when 'purchase' then 'resolved' else 'closed' end as nx,
             case when value > 30 then 'false_positive' end as d, value > 20 as evidence from events),
j as (select a.*, status, old_disposition, case when status <> nx and nx in ('pending', 'in_review') then null else coalesce(d, old_disposition) end as kept
      from a left join s on s.user_id = a.user_id),
k as (select *, case when status is null then 'not_found'
  when status <> nx and (status, nx) not in (('pending', 'in_review'), ('pending', 'resolved'), ('in_review', 'pending'), ('in_review', 'resolved'), ('resolved', 'in_review'), ('resolved', 'closed'), ('closed', 'in_review')) then 'invalid_transition'
  when (nx in ('resolved', 'closed')) <> (kept is not null) then 'invalid_disposition_for_status' when nx in ('resolved', 'closed') and not evidence then 'evidence_link_required' end as error from j)
select event_id, error, case when error is not null then 'rejected' when status = nx and kept is not distinct from old_disposition then 'no_op' else 'accepted' end as outcome,
       case when error is null then kept end as new_disposition from k""",
}
