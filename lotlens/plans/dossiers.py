"""The nested parcel dossier: header, sections and timeline of each part, from all tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.operators import dossier, rules, wide
from lotlens.plans import scoring
from lotlens.plans import valuation as v
from lotlens.runtime import cut, table

MOST = 5
_HEAD = ["municipality_name", "current_owner_name", "current_primary_address", "current_parcel_description"]


def _sections(spark: SparkSession, sf_dir: str, facts: DataFrame, sources: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, list[Column]]]:
    """The sections of parts: assessments with the years that only facts know, sales by their best match, peers, permits, appeals, reasons, timeline."""
    own = sources["assessments"].where("source = 'detail'").select("parcel_id", F.col("id").alias("assessment_id"), "year", "total_value", "valuation_date")
    known = facts.select("parcel_id", "year", F.col("assessment_total_value").alias("total_value"), F.col("assessment_valuation_date").alias("valuation_date"))
    history = dossier.assessment_history(own, known)
    line = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    matches = line.where("l_quantity > 25").select(
        F.col("l_partkey").alias("parcel_id"), F.col("l_orderkey").alias("txn"), (F.col("l_orderkey") * 10 + n).alias("match_id"), F.when(n != 3, n == 1).alias("is_primary"),
        F.when(F.col("l_discount") > 0.02, F.round(1 - F.col("l_discount"), 2)).alias("confidence"), F.when(n < 5, n).alias("match_rank"), F.col("l_returnflag").alias("match_method"),
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("txn"), F.to_date("o_orderdate").alias("transfer_date"), F.col("o_totalprice").cast("decimal(14,2)").alias("amount"))
    excluded = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("txn"), F.explode(F.array(F.lit("z_code"), F.when(F.col("o_orderstatus") == "P", "family_transfer").otherwise("a_code"))).alias("exclusion_code"), (F.col("o_orderkey") % 4 == 0).alias("is_active"))
    sales = dossier.matched_sales(matches, orders, excluded).select("parcel_id", "txn", "transfer_date", "amount", "match_method", "is_primary", F.array_join("exclusion_codes", ",").alias("codes"))
    sales = cut(sales, "zstd")  # read four times, each time with other columns
    permits = line.where("l_linenumber = 6").select(
        F.col("l_partkey").alias("parcel_id"), (F.col("l_orderkey") * 10 + n).alias("permit_id"), F.when(F.col("l_quantity") > 5, F.year("l_shipdate")).alias("year"), F.when(F.col("l_tax") > 0.02, F.to_date("l_shipdate")).alias("issued"), F.col("l_extendedprice").cast("decimal(14,2)").alias("amount"),
    )
    appeals = line.where("l_linenumber = 7").select(
        F.col("l_partkey").alias("parcel_id"), (F.col("l_orderkey") * 10 + n).alias("appeal_id"), F.year("l_shipdate").alias("year"), F.when(F.col("l_tax") > 0.04, F.to_date("l_shipdate")).alias("decided"), F.col("l_returnflag").alias("outcome"), F.col("l_extendedprice").cast("decimal(14,2)").alias("amount"),
    )
    scored = cut(rules.score(scoring.feature_rows(spark, sf_dir)).select("parcel_id", F.col("yr").alias("year"), "score", "band", "triggers", "peer_percentile", "assessment_to_sale_ratio"))
    peers = scored.select("parcel_id", "year", F.col("peer_percentile").cast("decimal(20,4)").alias("peer_percentile"), F.col("assessment_to_sale_ratio").cast("decimal(20,6)").alias("ratio"))
    reasons = scored.select("parcel_id", "year", "score", "band", F.array_join(F.transform("triggers", lambda t: t["reason"]), ",").alias("reasons"))
    p, cents = F.col("parcel_id"), lambda c: F.col(c).cast("double")
    none = F.lit(None).cast("date")
    events = dossier.timeline(
        dossier.event(own, "assessment", p, F.col("assessment_id"), F.col("valuation_date"), F.col("year"), cents("total_value")), dossier.event(sales, "sale", p, F.col("txn"), F.col("transfer_date"), F.year("transfer_date"), cents("amount")),
        dossier.event(permits, "permit", p, F.col("permit_id"), F.col("issued"), F.col("year"), cents("amount")), dossier.event(appeals, "appeal", p, F.col("appeal_id"), F.col("decided"), F.col("year"), cents("amount")),
        dossier.event(reasons, "score", p, F.col("year"), none, F.col("year"), F.col("score")),
    )
    newest = F.desc_nulls_last("year")
    closed = lambda *cs: [F.desc_nulls_last(c) for c in cs]  # noqa: E731  # ids made of order and line number may repeat, so the other columns end the order
    return {
        "assessments": (history, [newest, F.desc_nulls_last("assessment_id"), *closed("valuation_date", "total_value")]), "sales": (sales, [F.desc_nulls_last("transfer_date"), F.desc("txn")]), "peers": (peers, [newest]),
        "permits": (permits, [F.desc_nulls_last(F.coalesce("issued", F.make_date("year", F.lit(1), F.lit(1)))), F.desc("permit_id"), *closed("issued", "amount", "year")]),
        "appeals": (appeals, [F.desc_nulls_last(F.coalesce("decided", F.make_date("year", F.lit(1), F.lit(1)))), F.desc("appeal_id"), *closed("decided", "amount", "outcome", "year")]), "reasons": (reasons, [newest, F.desc("score")]), "timeline": (events, [F.asc("position")]),
    }


def parcel_dossiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dossier for each part; sections as texts of their first rows, and how many rows there are."""
    sources = v.fact_sources(spark, sf_dir)
    facts = cut(wide.parcel_year_facts(**sources, columns=[*_HEAD, "assessment_total_value", "assessment_valuation_date"]), "zstd")
    parcels = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("parcel_id"), F.substring("p_name", 1, 6).alias("trs_code"))
    sections = _sections(spark, sf_dir, facts, sources)
    found = dossier.documents(dossier.fact_header(parcels, facts, _HEAD), sections, MOST)

    def text(name: str) -> Column:
        fields = [c for c in sections[name][0].columns if c != "parcel_id"]
        row = lambda x: F.concat_ws("|", *[F.coalesce(x[c].cast("string"), F.lit("-")) for c in fields])
        return F.array_join(F.transform(name, row), ";").alias(name)

    return found.select("parcel_id", "trs_code", *_HEAD, *[c for name in sections for c in (text(name), F.col(f"n_{name}"))])


QUERIES = {"parcel_dossiers": parcel_dossiers}


def _section(name: str, source: str, order: str, fields: list[str]) -> str:
    text = " || '|' || ".join(f"coalesce(cast({f} as varchar), '-')" for f in fields)
    return f"""{name}_r as (select *, row_number() over (partition by parcel_id order by {order}) as place from {source}),
{name}_s as (select parcel_id, string_agg({text}, ';' order by place) filter (where place <= {MOST}) as {name}, count(*) as n_{name} from {name}_r group by parcel_id)"""


_NAMES = ["assessments", "sales", "peers", "permits", "appeals", "reasons", "timeline"]

SQL = {
    "parcel_dossiers": scoring._FEAT + f""",
facts as ({v.SQL["parcel_year_facts"]}),
own as (
  select l_partkey as parcel_id, l_orderkey * 10 + l_linenumber as assessment_id, year(l_shipdate) as year, case when l_discount < 0.09 then cast(l_extendedprice as decimal(14,2)) end as total_value,
         case when l_quantity > 25 then cast(l_shipdate as date) end as valuation_date from lineitem where l_linenumber <= 3 and l_returnflag = 'A'),
hist as (
  select * from own union all select parcel_id, null, year, assessment_total_value, assessment_valuation_date from facts f
  where not exists (select 1 from own where own.parcel_id = f.parcel_id and own.year = f.year)),
mt as (
  select *, row_number() over (partition by parcel_id, txn order by coalesce(is_primary, false) desc, confidence desc nulls last, match_rank nulls last, match_id) as k from (
    select l_partkey as parcel_id, l_orderkey as txn, l_orderkey * 10 + l_linenumber as match_id, case when l_linenumber <> 3 then l_linenumber = 1 end as is_primary,
           case when l_discount > 0.02 then round(1 - l_discount, 2) end as confidence, case when l_linenumber < 5 then l_linenumber end as match_rank, l_returnflag as match_method from lineitem where l_quantity > 25)),
sl as (
  select parcel_id, txn, cast(o_orderdate as date) as transfer_date, cast(o_totalprice as decimal(14,2)) as amount, match_method, is_primary,
         case when txn % 4 <> 0 then '' when o_orderstatus = 'P' then 'family_transfer,z_code' else 'a_code,z_code' end as codes from mt join orders on o_orderkey = txn where k = 1),
pm as (
  select l_partkey as parcel_id, l_orderkey * 10 + l_linenumber as permit_id, case when l_quantity > 5 then year(l_shipdate) end as year, case when l_tax > 0.02 then cast(l_shipdate as date) end as issued,
         cast(l_extendedprice as decimal(14,2)) as amount from lineitem where l_linenumber = 6),
ap as (
  select l_partkey as parcel_id, l_orderkey * 10 + l_linenumber as appeal_id, year(l_shipdate) as year, case when l_tax > 0.04 then cast(l_shipdate as date) end as decided, l_returnflag as outcome,
         cast(l_extendedprice as decimal(14,2)) as amount from lineitem where l_linenumber = 7),
pe as (select parcel_id, yr as year, cast(peer_percentile as decimal(20,4)) as peer_percentile, cast(assessment_to_sale_ratio as decimal(20,6)) as ratio from feat),
rs as (
  select b.parcel_id, b.yr as year, b.score, b.band, coalesce(string_agg(reason, ',' order by reason_rank), '') as reasons from banded b left join flags f on f.parcel_id = b.parcel_id and f.yr = b.yr group by b.parcel_id, b.yr, b.score, b.band),
ev as (
  select parcel_id, 'assessment' as event_type, assessment_id as row_id, coalesce(valuation_date, make_date(year, 1, 1)) as event_date, year as event_year, cast(total_value as double) as amount, 5 as r from own
  union all select parcel_id, 'sale', txn, transfer_date, year(transfer_date), cast(amount as double), 4 from sl
  union all select parcel_id, 'permit', permit_id, coalesce(issued, make_date(year, 1, 1)), year, cast(amount as double), 3 from pm
  union all select parcel_id, 'appeal', appeal_id, coalesce(decided, make_date(year, 1, 1)), year, cast(amount as double), 2 from ap
  union all select parcel_id, 'score', year, make_date(year, 12, 31), year, score, 1 from rs),
tl as (select *, row_number() over (partition by parcel_id order by event_date desc nulls last, r, row_id, amount desc) as position from ev),
{_section("assessments", "hist", "year desc nulls last, assessment_id desc nulls last", ["assessment_id", "year", "total_value", "valuation_date"])},
{_section("sales", "sl", "transfer_date desc nulls last, txn desc", ["txn", "transfer_date", "amount", "match_method", "is_primary", "codes"])},
{_section("peers", "pe", "year desc", ["year", "peer_percentile", "ratio"])},
{_section("permits", "pm", "coalesce(issued, make_date(year, 1, 1)) desc nulls last, permit_id desc", ["permit_id", "year", "issued", "amount"])},
{_section("appeals", "ap", "coalesce(decided, make_date(year, 1, 1)) desc nulls last, appeal_id desc", ["appeal_id", "year", "decided", "outcome", "amount"])},
{_section("reasons", "rs", "year desc, score desc", ["year", "cast(score as double)", "band", "reasons"])},
{_section("timeline", "tl", "position", ["event_type", "row_id", "event_date", "event_year", "cast(amount as double)", "position"])},
head as (select *, row_number() over (partition by parcel_id order by year desc) as k from facts)
select p_partkey as parcel_id, left(p_name, 6) as trs_code, municipality_name, current_owner_name, current_primary_address, current_parcel_description,
       {", ".join(f"coalesce({n}, '') as {n}, coalesce(n_{n}, 0) as n_{n}" for n in _NAMES)}
from part left join head h on h.parcel_id = p_partkey and k = 1 {" ".join(f"left join {n}_s on {n}_s.parcel_id = p_partkey" for n in _NAMES)}""",
}
