"""Queries on page details, codes, validation, paging and report roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.functions import parsing as P
from lotlens.functions import text as T
from lotlens.operators import features, pick, review
from lotlens.plans import scoring
from lotlens.plans.base import FACT, fact
from lotlens.runtime import cut, table
from lotlens.sources import imports, pages


def parcel_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number parts, township and range, and the three-valued exempt flag of strings made from parts."""
    p = table(spark, sf_dir, "part")
    k = F.lpad(F.col("p_partkey").cast("string"), 12, "0")
    number = F.concat(F.lit(" 061/"), F.substring(k, 1, 4), F.lit("-"), F.substring(k, 5, 3), F.when(F.col("p_size") % 2 == 0, "0").otherwise(""), F.lit("-"), F.substring(k, 8, 4), F.lit("-"), F.substring(k, 12, 1))
    place = F.when(F.col("p_size") > 25, F.concat(F.lit("T"), (F.col("p_size") % 20).cast("string"), F.lit("N R"), (F.col("p_size") % 9).cast("string"), F.lit("E"))).otherwise("none")
    tax = F.when(F.col("p_size") > 10, F.col("p_retailprice") > 1000)
    class_code = F.when(F.col("p_size") > 15, F.substring("p_type", 1, 1))
    flag = P.exempt_flag(class_code, F.when(F.col("p_size") != 5, F.col("p_size") < 20), tax, F.col("p_name"), ["CITY", "7"])
    rows = p.select("p_partkey", P.parcel_parts(number).alias("n"), P.township_range(place).alias("t"), flag.alias("exempt"))
    return rows.select("p_partkey", "n.township", "n.section", "n.parcel", F.col("t.township").alias("t_town"), F.col("t.range").alias("t_range"), "exempt")


def negative_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose map of amounts has a negative one, with their evidence links."""
    e = table(spark, sf_dir, "events")
    data = F.create_map(F.lit("Total Amount"), F.concat(F.lit("$"), F.round(F.col("value") - 5, 2).cast("string")), F.lit("note"), F.lit("-9"))
    links = F.concat(F.lit("kind=photo,ref="), F.col("user_id").cast("string"), F.lit(";kind=deed,ref=d1,label=x;kind=bad,ref=z;kind=photo,ref="), F.col("user_id").cast("string"))
    found = T.evidence_links(links, ["photo", "deed"])
    return e.where(P.any_negative_amount(data)).select("event_id", F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["ref"], x["label"])), "|").alias("links"))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part-years as feature rows with their details, some of which are odd, and their errors."""
    rows = scoring.feature_rows(spark, sf_dir)
    p, y = F.col("parcel_id"), F.col("yr")
    key = lambda year: F.struct(p.alias("parcel_id"), year.alias("year"))
    made = rows.select(
        F.when(p % 37 != 0, p.cast("string")).otherwise(" ").alias("parcel_id"), F.when(p % 41 != 0, y).otherwise(0).alias("year"), F.when(p % 43 != 0, "v1").alias("feature_version"),
        F.when(p % 5 != 0, F.col("assessment_to_sale_ratio")).alias("assessment_to_sale_ratio"), (F.col("peer_percentile") + F.when(p % 7 == 0, 0.5).otherwise(0.0)).alias("peer_percentile"), "permit_adjusted_expected_change",
        "appeal_value_delta_3y", "appeal_success_rate_3y", F.when(p % 11 == 0, "odd").when(F.col("permit_adjusted_expected_change").isNull(), "unknown").when(F.col("permit_adjusted_expected_change") == 0, "none").otherwise("declared").alias("permit_basis"),
        F.when(p % 3 == 0, F.array(key(y), key(y - 1))).when(p % 3 == 1, F.array(key(y))).alias("permit_source_keys"), F.when(p % 2 == 0, F.array(key(y - 1), key(y))).alias("appeal_source_keys"),
        F.when(F.col("appeal_value_delta_3y").isNull(), "missing").otherwise("known").alias("appeal_value_detail_status"), F.when(p % 13 == 0, "none").otherwise("known").alias("appeal_outcome_detail_status"),
        F.when(p % 4 == 0, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("a"))).alias("related_parcel_ids"), (p % 2 + 1).cast("int").alias("relationship_count"),
        F.when(p % 17 != 0, F.array(*map(F.lit, features.SOURCE_REFS))).otherwise(F.array(F.lit("sales"))).alias("source_ref_keys"), features.quality_flags(F.when(y < 1995, "early_year"), F.when(F.col("peer_percentile") > 0.5, "upper_half")).alias("quality_flags"),
    )
    return features.validated(made)


def feature_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of kept and skipped rows, flags and errors."""
    return features.build_diagnostics(_checked(spark, sf_dir))


def feature_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 skipped rows, with their errors as text."""
    rows = _checked(spark, sf_dir).where("parcel_id <> ' ' and year > 0")
    return features.skipped_sample(rows).select("parcel_id", "year", F.array_join("errors", ",").alias("errors"))


def review_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third page of the reviews, newest first."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return review.with_pages(pick.page(e, [F.desc("ts"), F.desc("event_id")], 3, 40), e, 40)


def next_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next hundred orders to read, playing pages: not done yet, beyond the resume point, in id order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", 404).otherwise(200).alias("status_code"), F.when(F.col("o_totalprice") > 200000, F.col("o_orderdate")).alias("parsed_at"))
    return imports.unread_pages(o, 500, 100, page_id="o_orderkey").select("o_orderkey")


def report_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons and bands over all rows that need review."""
    return scoring.review_reasons(spark, sf_dir).groupBy("kind", "name").agg(F.count("*").alias("n"))


def detail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with one detail table of years across: turned into one record for each page and year."""
    f = fact(spark, sf_dir)
    html = f.groupBy("parcel_id").agg(F.array_sort(F.collect_list(F.struct("yr", "v"))).alias("c"))
    row = lambda tag, c: F.array_join(F.transform("c", lambda x: F.concat(F.lit(f"<{tag}>"), x[c].cast("string"), F.lit(f"</{tag}>"))), "")
    text = F.concat(F.lit("<h3>Valuation</h3><table><tr><th>Item</th>"), row("th", "yr"), F.lit("</tr><tr><td>Total</td>"), row("td", "v"), F.lit("</tr></table>"))
    long = cut(pages.extract(html.select(F.col("parcel_id").alias("page_id"), text.alias("html"))), "zstd")  # read several times
    turned = pages.year_columns(pages.table_records(long, "valuation"), "Item")
    return turned.select("page_id", "year", P.page_money(F.col("data")["Total"]).alias("total"))


def routed_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail rows of pages routed into sections by the header rows above them."""
    f = fact(spark, sf_dir)
    row = F.concat(F.lit("<tr><td>"), F.when(F.col("yr") == 1996, "Credits").when(F.col("yr") == 1998, "Special charges").otherwise(F.col("yr").cast("string")), F.lit("</td><td>"), F.col("v").cast("string"), F.lit("</td></tr>"))
    html = f.groupBy("parcel_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("yr", row.alias("h")))), lambda x: x["h"]), "").alias("r"))
    html = html.select(F.col("parcel_id").alias("page_id"), F.concat(F.lit("<table><tr><th>Item</th><th>Amount</th></tr>"), "r", F.lit("</table>")).alias("html"))
    long = cut(pages.extract(html), "zstd")
    rows = pages.table_records(long).select("page_id", "row", F.col("data")["Item"].alias("item"), "data")
    found = pages.routed_details(rows, ["page_id"], ["row"], "item", {"credit": "^credits", "special": "^special"})
    return found.select("page_id", "detail", F.size("rows").alias("n"))


def lineage_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Related parcels from links of pages made of orders: customers link to the parts of their lines."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    href = F.concat(F.lit("<a href='/parcel/"), F.lpad(F.col("l_partkey").cast("string"), 12, "0"), F.lit("'>x</a>"))
    html = line.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", href.alias("h")))), lambda x: x["h"]), " ").alias("html"))
    long = pages.extract(html, page_id="l_orderkey")
    found = pages.lineage_links(pages.links(long), F.when(F.col("position") == 0, "parent").otherwise("child"))
    return found.select(F.col("page_id"), F.col("related").cast("long").alias("related"), "kind")


QUERIES = {f.__name__: f for f in (parcel_codes, negative_amounts, feature_validation, feature_skips, review_listing, next_pages, report_rollup, detail_records, routed_details, lineage_of_pages)}

_FEAT = scoring._FEAT

_CHECKED = """, mk as (
  select parcel_id as p, case when parcel_id % 37 <> 0 then cast(parcel_id as varchar) else ' ' end as parcel_id, case when parcel_id % 41 <> 0 then yr else 0 end as year, parcel_id % 43 = 0 as no_version,
         case when parcel_id % 5 <> 0 then assessment_to_sale_ratio end as ratio, peer_percentile + case when parcel_id % 7 = 0 then 0.5 else 0 end as peer, permit_adjusted_expected_change as expected, appeal_value_delta_3y as delta, appeal_success_rate_3y as rate,
         case when parcel_id % 11 = 0 then 'odd' when permit_adjusted_expected_change is null then 'unknown' when permit_adjusted_expected_change = 0 then 'none' else 'declared' end as basis,
         case when appeal_value_delta_3y is null then 'missing' else 'known' end as vs, case when parcel_id % 13 = 0 then 'none' else 'known' end as os, parcel_id % 2 = 0 as akeys, parcel_id % 3 < 2 as pkeys,
         list_filter([case when yr < 1995 then 'early_year' end, case when peer_percentile > 0.5 then 'upper_half' end], lambda x: x is not null) as flags from feat),
chk as (
  select parcel_id, year, flags, list_sort(list_filter([
    case when trim(parcel_id) = '' then 'missing_required_parcel_id' end, case when year <= 0 then 'invalid_year' end, case when no_version then 'missing_required_feature_version' end, case when ratio < 0 then 'negative_assessment_to_sale_ratio' end,
    case when peer < 0 or peer > 1 then 'out_of_bounds_peer_percentile' end, case when peer is not null and ratio is null then 'peer_percentile_without_ratio' end, case when rate < 0 or rate > 1 then 'out_of_bounds_appeal_success_rate_3y' end,
    case when basis = 'none' and coalesce(expected, 1) <> 0 then 'permit_basis_none_with_nonzero_expected_change' end, case when basis = 'none' and pkeys then 'permit_basis_none_with_source_keys' end, case when basis = 'unknown' and expected is not null then 'permit_basis_unknown_with_expected_change' end,
    case when basis = 'declared' and expected is null then 'permit_basis_known_without_expected_change' end, case when basis = 'declared' and not pkeys then 'permit_basis_known_without_source_keys' end, case when basis = 'odd' then 'invalid_permit_basis' end,
    case when p % 3 = 0 then 'permit_source_keys_not_sorted_unique' end, case when vs = 'known' and delta is null then 'appeal_value_known_without_value' end, case when vs = 'known' and not akeys then 'appeal_value_known_without_source_keys' end,
    case when vs = 'missing' and delta is not null then 'appeal_value_missing_with_value' end, case when vs = 'missing' and not akeys then 'appeal_value_missing_without_source_keys' end, case when os = 'none' and rate is not null then 'appeal_outcome_none_with_rate' end,
    case when os = 'none' and akeys then 'appeal_outcome_none_with_source_keys' end, case when os = 'known' and not akeys then 'appeal_outcome_known_without_source_keys' end, case when p % 4 = 0 then 'lineage_related_parcels_not_sorted_unique' end,
    case when p % 17 = 0 then 'missing_source_refs_lineage' end, case when p % 17 <> 0 and p % 2 + 1 <> case when p % 4 = 0 then 2 else 1 end then 'lineage_relationship_count_mismatch' end, case when p % 17 = 0 then 'missing_required_source_refs_keys' end],
    lambda x: x is not null)) as errors from mk)"""

SQL = {
    "parcel_codes": """with p as (select *, lpad(cast(p_partkey as varchar), 12, '0') as k from part)
select p_partkey, case when p_size % 2 = 1 then substr(k, 1, 2) end as township, case when p_size % 2 = 1 then substr(k, 5, 2) end as section, case when p_size % 2 = 1 then substr(k, 8, 4) end as parcel,
       case when p_size > 25 then lpad(cast(p_size % 20 as varchar), 2, '0') end as t_town, case when p_size > 25 then lpad(cast(p_size % 9 as varchar), 2, '0') end as t_range,
       case when p_size > 15 and upper(substr(p_type, 1, 1)) = 'X' then true when p_size <> 5 and p_size < 20 and p_size > 10 and not p_retailprice > 1000 and regexp_matches(upper(p_name), 'CITY|7') then true
            when p_size > 15 or (p_name is not null and p_size <> 5) then false end as exempt from p""",
    "negative_amounts": """select event_id, 'deed:d1:x|photo:' || user_id as links from events where round(value - 5, 2) < 0""",
    "feature_validation": _FEAT + f"""{_CHECKED},
f as (select unnest(case when len(errors) = 0 then flags else [] end) as flag from chk),
x as (
  select 'rows' as kind, case when len(errors) = 0 then 'inserted' else 'skipped' end as name from chk union all select 'rows', 'with_quality_flags' from chk where len(errors) = 0 and len(flags) > 0
  union all select 'rows', 'quality_warnings' from f union all select 'flag', flag from f union all select 'error', unnest(errors) from chk)
select kind, name, count(*) as n from x group by all""",
    "feature_skips": _FEAT + f"""{_CHECKED}
select parcel_id, year, array_to_string(errors, ',') as errors from chk where len(errors) > 0 and parcel_id <> ' ' and year > 0 order by parcel_id, year limit 25""",
    "review_listing": "select event_id, ts, event_type, count(*) over () as n_total, cast(ceil(count(*) over () / 40) as bigint) as n_pages from events order by ts desc, event_id desc limit 40 offset 80",
    "next_pages": "select o_orderkey from orders where o_orderstatus <> 'P' and o_orderkey > 500 and not o_totalprice > 200000 order by o_orderkey limit 100",
    "report_rollup": _FEAT + """select 'reason' as kind, reason as name, count(*) as n from flags where band <> 'low' group by all
union all select 'band', band, count(*) from banded where requires_review group by all""",
    "detail_records": f"with {FACT} select parcel_id as page_id, yr as year, cast(v as decimal(14,2)) as total from fact",
    "routed_details": f"""with {FACT}, o as (select *, max(case when yr in (1996, 1998) then yr end) over (partition by parcel_id order by yr) as opened from fact)
select parcel_id as page_id, case opened when 1996 then 'credit' else 'special' end as detail, count(*) as n from o where yr not in (1996, 1998) and opened is not null group by all""",
    "lineage_of_pages": """with l as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) - 1 as pos from lineitem),
m as (select l_orderkey, l_partkey, max(pos) as pos from l group by all)
select l_orderkey as page_id, l_partkey as related, case when pos = 0 then 'parent' else 'child' end as kind from m""",
}
