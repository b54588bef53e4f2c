"""Queries on fetches, payments, characteristics, profiles and scopes.

Orders play fetches and their page, their lines the rows parsed from it, parts the parcels of pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.functions import parsing as P
from lotlens.operators import dossier, facts, features, match, monitor, pick, profile, quality
from lotlens.plans import valuation as v
from lotlens.plans.base import FACT, SALE, fact, sale
from lotlens.runtime import table
from lotlens.sources import pages


def _fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, dear = table(spark, sf_dir, "orders"), F.col("o_totalprice")
    return o.select(
        F.col("o_orderkey").alias("fetch_id"), F.col("o_custkey").alias("parcel_id"), F.when(F.col("o_orderstatus") == "P", 404).when(F.col("o_orderkey") % 11 != 0, 200).alias("status_code"),
        F.when(F.col("o_orderkey") % 13 == 0, "").when(F.col("o_orderkey") % 17 != 0, F.concat(F.lit("raw/"), F.col("o_orderkey").cast("string"))).alias("raw_path"),
        F.when(dear > 60000, F.col("o_orderdate")).alias("parsed_at"), F.when(dear > 300000, "bad table").alias("parse_error"), F.col("o_orderdate").alias("fetched_at"),
    )


_FETCHES = """fetches as (
  select o_orderkey as fetch_id, o_custkey as parcel_id, case when o_orderstatus = 'P' then 404 when o_orderkey % 11 <> 0 then 200 end as status_code,
         case when o_orderkey % 13 = 0 then '' when o_orderkey % 17 <> 0 then 'raw/' || o_orderkey end as raw_path,
         case when o_totalprice > 60000 then o_orderdate end as parsed_at, case when o_totalprice > 300000 then 'bad table' end as parse_error, o_orderdate as fetched_at from orders)"""


def _child(spark: SparkSession, sf_dir: str, cond: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(cond).select(F.col("l_orderkey").alias("fetch_id"))


def fetch_parse_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four codes of fetches whose state and parsed rows disagree."""
    return quality.fetch_consistency(_fetches(spark, sf_dir), [_child(spark, sf_dir, "l_quantity > 45"), _child(spark, sf_dir, "l_discount > 0.09")])


def exempt_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    rows = p.select(
        "p_partkey", F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("x"), "p_type")).when(F.col("p_size") % 5 != 1, F.col("p_type")).alias("class_code"),
        F.when(F.col("p_size") % 3 != 0, F.col("p_size") % 3 == 1).alias("exempt"), (F.col("p_size") < 25).alias("empty"), F.when(F.col("p_size") % 7 != 0, F.col("p_size") % 7 > 3).alias("tax"),
    )
    return quality.exempt_consistency(rows, F.col("p_partkey"), "class_code", "exempt", "empty", "tax")


def payment_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment rows as maps of texts against flags of orders and roll-ups of customers' years."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_shipdate")
    date = F.when(F.col("l_discount") < 0.04, " No payments found. ").otherwise(F.col("l_shipdate").cast("string"))
    data = F.create_map(F.lit("Date of Payment"), F.when(F.col("l_linenumber") % 2 == 0, date).otherwise(""), F.lit("col_2"), date)
    signals = quality.payment_signals(line.select(F.col("l_orderkey").alias("fetch_id"), data.alias("data"), (F.col("l_tax") > 0.03).alias("own")), "fetch_id", P.placeholder_payment(F.col("data")), F.col("own"))
    o = table(spark, sf_dir, "orders").withColumns({"key": F.col("o_orderkey").cast("string"), "fetch_id": F.col("o_orderkey"), "n": F.col("o_orderkey") % 4})
    flags = o.select("key", "fetch_id", F.when(F.col("n") != 3, F.col("n") > 0).alias("available"))
    rolled = o.select("key", "fetch_id", F.when(F.col("n") != 1, F.col("n") == 2).alias("placeholder"), (F.col("o_orderkey") % 3).alias("event_count"), F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice")).alias("total"), F.lit(None).cast("date").alias("first_date"), F.lit(None).cast("date").alias("last_date"))
    return quality.payment_semantics(signals, flags, rolled)


SECTIONS = {"assessment": "l_quantity > 40", "tax": "l_discount > 0.08", "payment": "l_tax > 0.07"}


def half_snapshot(spark: SparkSession, sf_dir: str, late: bool | None) -> DataFrame:
    """Coverage, selector misses and field presence of the early or the late fetches (None: all) as metric rows; late parsers fail more often."""
    day = lambda c: F.lit(True) if late is None else (F.col(c) >= "1995-06-01") == late
    parcels = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("parcel_id"))
    orders = table(spark, sf_dir, "orders").where(day("o_orderdate")).select(F.col("o_custkey").alias("parcel_id"), "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("year"))
    fetches = _fetches(spark, sf_dir).where(day("fetched_at"))
    if late:
        fetches = fetches.withColumn("parse_error", F.when(F.col("fetch_id") % 4 == 0, "new layout").otherwise(F.col("parse_error")))
    of = {"parcel_summary": "= '1-URGENT'", "parcel_year_fact": "<> '2-HIGH'", "parcel_characteristic": "<> '5-LOW'", "parcel_lineage": "= '3-MEDIUM'"}
    years = {"parcel_year_facts": orders.where("o_orderstatus <> 'P'"), "source_parcel_years": orders}
    named = profile.counts(fetches, parcels, {k: orders.where(f"o_orderpriority {c}") for k, c in of.items()}, {k: _child(spark, sf_dir, c) for k, c in SECTIONS.items()}, years=years)
    return profile.snapshot(profile.coverage(named, list(of), list(SECTIONS)), _presence(table(spark, sf_dir, "lineitem").where(day("l_shipdate"))))


def profile_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return half_snapshot(spark, sf_dir, None)


def field_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _presence(table(spark, sf_dir, "lineitem"))


def _presence(line: DataFrame) -> DataFrame:
    """Non-empty fields of detail rows: a text, a list and a number."""
    rows = line.select(
        F.when(F.col("l_quantity") > 10, F.when(F.col("l_quantity") > 20, F.col("l_returnflag")).otherwise("")).alias("tax_amount_summary"),
        F.when(F.col("l_tax") > 0.01, F.when(F.col("l_tax") > 0.03, F.array("l_linestatus")).otherwise(F.array().cast("array<string>"))).alias("tax_rate_rows"),
        F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("installment_rows"),
    )
    return profile.field_presence(rows, ["tax_amount_summary", "tax_rate_rows", "installment_rows"])


#: num / den at four digits, ties half up in whole numbers (a quotient of doubles may lie on either side of a tie).
_RATE = "((num * 20000 + den) // (2 * den)) / 10000"

_PRESENCE = """presence as (
  select unnest(['tax_amount_summary', 'tax_rate_rows', 'installment_rows']) as field, unnest([a, b, c]) as num, den from (
    select count(*) filter (where l_quantity > 20) as a, count(*) filter (where l_tax > 0.03) as b, count(*) filter (where l_discount > 0.02) as c, count(*) as den from lineitem))"""


def snapshot_sql(late: bool | None, name: str) -> str:
    """Common tables that end in ``name`` (metric, num, den), as half_snapshot makes them."""
    day = lambda c: "true" if late is None else f"({c} >= timestamp '1995-06-01') = {str(late).lower()}"
    error = "case when fetch_id % 4 = 0 then 'new layout' else parse_error end" if late else "parse_error"
    parcels = lambda c: f"(select count(distinct o_custkey) from {name}_o where o_orderpriority {c})"
    lacks = lambda c: f"(select count(*) from {name}_f where status_code = 200 and fetch_id not in (select l_orderkey from lineitem where {c}))"
    return f"""{_FETCHES.replace("fetches as", f"{name}_all as")},
{name}_f as (select * exclude (parse_error), {error} as parse_error from {name}_all where {day("fetched_at")}), {name}_o as (select * from orders where {day("o_orderdate")}),
{name}_l as (select count(*) filter (where l_quantity > 20) as a, count(*) filter (where l_tax > 0.03) as b, count(*) filter (where l_discount > 0.02) as c, count(*) as den from lineitem where {day("l_shipdate")}),
{name}_n as (
  select (select count(*) from {name}_f where status_code = 200) as good, (select count(parsed_at) from {name}_f) as parsed, (select count(parse_error) from {name}_f) as errors, (select count(*) from customer) as parcels,
         {parcels("= '1-URGENT'")} as s, {parcels("<> '2-HIGH'")} as f, {parcels("<> '5-LOW'")} as h, {parcels("= '3-MEDIUM'")} as g,
         (select count(distinct (o_custkey, year(o_orderdate))) from {name}_o where o_orderstatus <> 'P') as y, (select count(distinct (o_custkey, year(o_orderdate))) from {name}_o) as sy,
         {lacks("l_quantity > 40")} as m1, {lacks("l_discount > 0.08")} as m2, {lacks("l_tax > 0.07")} as m3),
{name} as (
  select 'coverage.parsed_successful_fetch_rate' as metric, parsed as num, good as den from {name}_n union all select 'coverage.parse_error_successful_fetch_rate', errors, good from {name}_n
  union all select 'coverage.parcel_summary_parcel_rate', s, parcels from {name}_n union all select 'coverage.parcel_year_fact_parcel_rate', f, parcels from {name}_n
  union all select 'coverage.parcel_characteristic_parcel_rate', h, parcels from {name}_n union all select 'coverage.parcel_lineage_parcel_rate', g, parcels from {name}_n
  union all select 'coverage.parcel_year_fact_source_year_rate', y, sy from {name}_n
  union all select 'selector_miss.assessment_fetch_rate', m1, good from {name}_n union all select 'selector_miss.tax_fetch_rate', m2, good from {name}_n union all select 'selector_miss.payment_fetch_rate', m3, good from {name}_n
  union all select 'tax_detail_field_presence.' || unnest(['tax_amount_summary', 'tax_rate_rows', 'installment_rows']) || '.rate', unnest([a, b, c]), den from {name}_l
  union all select 'extraction_null_rate.' || unnest(['tax_amount_summary', 'tax_rate_rows', 'installment_rows']), den - unnest([a, b, c]), den from {name}_l)"""


def run_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs, line states as their stages."""
    state = F.when(F.col("l_discount") > 0.09, "failed").when(F.col("l_tax") > 0.07, "blocked").otherwise("succeeded")
    stages = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set(state).alias("stages"))
    runs = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.when(F.col("o_orderstatus") == "P", "failed").otherwise("succeeded").alias("status"))
    return monitor.failed_fractions(runs.join(stages, "o_orderkey", "left"), ["o_orderpriority"], "status", "stages")


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    conf = F.when(F.col("l_quantity") > 5, F.round(1 - F.col("l_discount").cast("double"), 2))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("txn"), F.col("l_partkey").alias("parcel_id"), (F.col("l_tax") > 0.06).alias("is_primary"), conf.alias("confidence"),
        F.when(F.col("l_quantity") > 25, F.col("l_linenumber")).alias("match_rank"), (F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 100 + F.col("l_partkey") % 100).alias("match_id"),
    )


def dossier_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.dossier_match(_matches(spark, sf_dir), "txn", "match_id").select("txn", "match_id", "is_primary", "confidence")


def _context(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = v.events(spark, sf_dir).groupBy("parcel_id", "yr").agg(F.count_if(F.col("outcome") == "F").alias("appeals"), F.coalesce(F.max(F.col("status") == "A"), F.lit(False)).alias("recent_permit"))
    area = F.when(F.col("yr") % 4 != 0, F.col("muni")).alias("area")
    known = fact(spark, sf_dir).select("parcel_id", "yr", area, "v").join(rolled, ["parcel_id", "yr"], "left")
    return match.sale_signals(sale(spark, sf_dir).select("txn", "parcel_id", "yr", "price"), known)


def sale_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _context(spark, sf_dir).select("txn", "has_context", "has_year", "has_permit", "has_appeal", "has_gap", "area")


def area_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.area_signals(_context(spark, sf_dir))


_CONTEXT = f"""with {FACT}, {SALE}, {v._EVENTS},
rolled as (select parcel_id, yr, count(*) filter (where outcome = 'F') as appeals, coalesce(bool_or(status = 'A'), false) as permit from ev group by all),
area as (select *, case when yr % 4 <> 0 then muni end as a from fact),
newest as (select parcel_id, first(a order by yr desc) filter (where a is not null) as newest from area group by all),
sig as (
  select s.txn, n.parcel_id is not null as has_context, f.parcel_id is not null as has_year, coalesce(permit, false) as has_permit, coalesce(appeals > 0, false) as has_appeal,
         coalesce(f.v > 0 and (cast(s.price as double) / cast(f.v as double) >= 1.5 or cast(s.price as double) / cast(f.v as double) <= 0.5), false) as has_gap, coalesce(f.a, newest, 'UNKNOWN') as area
  from sale s left join area f on f.parcel_id = s.parcel_id and f.yr = s.yr left join rolled r on r.parcel_id = f.parcel_id and r.yr = f.yr left join newest n on n.parcel_id = s.parcel_id)
"""


def peer_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows of all years with the facts that there are: years before 1994 lack theirs."""
    own = v.yoy_change(spark, sf_dir)
    return dossier.peer_context(own, fact(spark, sf_dir).where("yr >= 1994").select("parcel_id", "yr", "muni", "v"), ["parcel_id", "yr"])


def _characteristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as pages: links and texts from their HTML, the rest as the parsers would give it."""
    p, size = table(spark, sf_dir, "part"), F.col("p_size")
    when = lambda cond, value: F.when(F.expr(cond), value)
    html = F.concat(
        F.when(size % 3 == 0, "<a href='https://www.bing.com/maps?x=1'>see</a>").otherwise(""), F.when(size % 4 == 0, "<a href='/m'>Google Map</a>").otherwise(""),
        F.when(size % 5 == 0, "<a href='http://gis.county.test/view'>x</a>").otherwise(""), F.when(size < 10, P.NO_TAX).when(size < 20, P.TAX_TITLE).otherwise(""), F.when(size % 6 == 1, P.NO_PAYMENTS).otherwise(""),
    )
    p = p.withColumns({"html": html, "page_id": F.col("p_partkey")})
    found = pages.map_links(pages.links(pages.extract(p)), ("County Map", ("gis.county.test",)))
    two = F.lpad((F.col("p_partkey") % 90 + 10).cast("string"), 2, "0")
    rows = p.select(
        "page_id", F.col("html").alias("page_text"), when("p_size % 2 = 0", F.concat(F.lit("061/"), two, two, F.lit("-"), two, F.lit("0-1234-5"))).alias("number"), when("p_size % 8 = 0", F.lit("  ")).alias("municipality"),
        when("p_size % 9 = 0", F.lit("T7N R9E")).alias("township_range"), when("p_size % 10 = 0", F.lit("31")).alias("section"), F.lit(None).cast("string").alias("quarter"), when("p_size % 7 = 0", F.lit("Ne1/4 SW 1/4 sec 3")).alias("description"),
        when("p_size % 3 = 1", F.concat(F.lit("City of "), "p_brand")).alias("owner"), when("p_size > 30", F.lit(2020)).alias("year"), when("p_size % 11 = 0", F.lit("x4")).otherwise(when("p_size > 40", F.lit("G1"))).alias("class_code"),
        when("p_size > 45", F.col("p_retailprice")).alias("acres"), F.lit(None).cast("double").alias("ratio"), F.lit(None).cast("double").alias("fair_value"), when("p_size > 35", F.lit(1)).alias("n_tax"),
        when("p_size % 5 = 2", F.lit(1)).alias("n_paid"), when("p_size % 5 = 3", F.lit(1)).alias("n_placeholder"), when("p_size = 12", F.lit(3)).alias("n_jurisdictions"), when("p_size % 4 < 3", size % 4).alias("n_values"),
    )
    return pages.characteristics(rows, found)


def characteristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _characteristics(spark, sf_dir).select(
        "page_id", "state_municipality_code", "township", "range", "section", "quarter_quarter", "has_county_map_link", "has_google_map_link", "has_bing_map_link", "current_tax_info_available",
        "current_payment_history_available", "is_exempt_style_page", "has_empty_valuation_breakout", "has_empty_tax_section", "complete",
    )


def best_characteristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each brand the page with the most known fields, then the latest."""
    brand = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), "p_brand", (F.col("p_partkey") % 37).alias("at"))
    return pick.largest_row(_characteristics(spark, sf_dir).join(brand, "page_id"), ["p_brand"], ["complete", "at", "page_id"], ["page_id", "complete"])


_CHARACTERISTICS = """c as (
  select p_partkey as page_id, p_brand, p_size as z, cast(p_partkey % 90 + 10 as varchar) as two, case when p_size % 11 = 0 then 'x4' when p_size > 40 then 'G1' end as cls,
         case when p_size < 10 then false when p_size > 35 or p_size < 20 then true end as tax, case when p_size % 4 < 3 then p_size % 4 = 0 end as empty_values from part),
d as (
  select page_id, p_brand, case when z % 2 = 0 then '061' end as state_municipality_code, case when z % 9 = 0 then '07' when z % 2 = 0 then two end as township,
         case when z % 9 = 0 then '09' when z % 2 = 0 then two end as range, case when z % 10 = 0 then '31' when z % 2 = 0 then two end as section, case when z % 7 = 0 then 'NE of the SW' end as quarter_quarter,
         case when z % 5 = 0 then true end as has_county_map_link, case when z % 4 = 0 then true end as has_google_map_link, case when z % 3 = 0 then true end as has_bing_map_link,
         tax as current_tax_info_available, case when z % 6 = 1 then false when z % 5 = 2 then true when z % 5 = 3 then false end as current_payment_history_available,
         case when cls = 'x4' or (empty_values and not tax and z % 3 = 1) then true when cls is not null or (z % 3 = 1 and empty_values is not null) then false end as is_exempt_style_page,
         empty_values as has_empty_valuation_breakout, case when z < 10 then true when z < 20 then false end as has_empty_tax_section,
         (z % 2 = 0)::int + (z > 30)::int + (cls is not null)::int + (z > 45)::int + (z = 12)::int as others from c),
e as (
  select *, others + (state_municipality_code is not null)::int + (township is not null)::int + (range is not null)::int + (section is not null)::int + (quarter_quarter is not null)::int
         + (has_county_map_link is not null)::int + (has_google_map_link is not null)::int + (has_bing_map_link is not null)::int + (current_tax_info_available is not null)::int
         + (current_payment_history_available is not null)::int + (is_exempt_style_page is not null)::int + (has_empty_valuation_breakout is not null)::int + (has_empty_tax_section is not null)::int as complete from d)
"""


def latest_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last fetch of each link: customers link to parts, by priority as type."""
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("related"))
    links = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("parcel_id"), F.col("o_orderpriority").alias("kind"), "o_orderdate").join(line, "o_orderkey")
    return pick.largest_row(links, ["parcel_id", "related", "kind"], ["o_orderdate", "o_orderkey"], ["o_orderkey"])


def parcel_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the parcels that some sale names."""
    return facts.key_scope(fact(spark, sf_dir), sale(spark, sf_dir).where("st = 'P'"), "parcel_id").select("parcel_id", "yr", "v")


def resolved_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders name a part by its number, directly or formatted; some numbers are ambiguous, some ids are known."""
    p = table(spark, sf_dir, "part")
    parcels = p.select(F.col("p_partkey").alias("parcel_id"), F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("d"), F.expr("p_partkey div 2").cast("string"))).alias("direct"), F.concat(F.lit("d"), (F.col("p_partkey") + 1).cast("string")).alias("formatted"))
    events = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).alias("parcel_id"), F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("number"))
    return facts.resolve_parcels(events, parcels, "number").select("o_orderkey", "resolved")


def parse_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each page whether its parse failed, and how; some pages begin with a section that no parser knows."""
    own = table(spark, sf_dir, "pages").select("page_id", F.concat(F.when(F.col("page_id") % 10 == 3, "<![odd[x]]>").otherwise(""), F.coalesce("html", F.lit(""))).alias("html"))
    bad = pages.errors(pages.extract(own)).groupBy("page_id").agg(F.min("error").alias("error"), F.count("*").alias("n"))
    return own.select("page_id").join(bad, "page_id", "left").select("page_id", F.col("n").isNotNull().alias("failed"), "error")


def feature_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality flags of part-years with the sale they refer to."""
    rows = v.with_sale_ratio(fact(spark, sf_dir), v.selected_sale(spark, sf_dir))
    flags = features.quality_flags(F.col("ratio_flag"), F.when(F.col("yr") < 1994, "early_year"), F.when(F.col("ratio") > 2, "high_ratio"), F.when(F.col("ratio") > 4, "high_ratio"))
    refs = F.struct(F.struct("parcel_id", "yr").alias("assessment"), F.struct(F.col("txn").alias("sales_transaction_id")).alias("sales"))
    return rows.withColumn("source_refs", refs).select("parcel_id", "yr", F.array_join(flags, ",").alias("flags"), F.col("source_refs.sales.sales_transaction_id").alias("txn"))


QUERIES = {f.__name__: f for f in (
    fetch_parse_checks, exempt_checks, payment_checks, profile_snapshot, field_presence, run_failures, dossier_match, sale_signals, area_signals, peer_context, characteristics,
    best_characteristics, latest_lineage, parcel_scope, resolved_events, parse_outcomes, feature_flags,
)}

SQL = {
    "fetch_parse_checks": f"""with {_FETCHES}, withrows as (select distinct l_orderkey as fetch_id from lineitem where l_quantity > 45 or l_discount > 0.09),
j as (select f.*, s.fetch_id is not null as has from fetches f left join withrows s using (fetch_id))
select 'fetch_parse_consistency' as "check", cast(fetch_id as varchar) as key, code from (
  select fetch_id, 'missing_raw_path' as code from j where status_code = 200 and coalesce(raw_path, '') = ''
  union all select fetch_id, 'unparsed_successful_fetch' from j where status_code = 200 and parsed_at is null and parse_error is null
  union all select fetch_id, 'parsed_non_200_fetch' from j where status_code is distinct from 200 and parsed_at is not null
  union all select fetch_id, 'parsed_without_records' from j where parsed_at is not null and parse_error is null and not has)""",
    "exempt_checks": """select 'parcel_characteristics_consistency' as "check", cast(p_partkey as varchar) as key, code from (
  select p_partkey, 'missing_exempt_style_flag' as code from part where p_size % 5 = 0 and p_size % 3 <> 1
  union all select p_partkey, 'unsupported_exempt_style_flag' from part where p_size % 5 <> 0 and p_size % 3 = 1 and not (p_size < 25 and p_size % 7 between 1 and 3))""",
    "payment_checks": """with sig as (
  select l_orderkey as k, bool_or(l_discount >= 0.04) as has_real, bool_or(l_discount < 0.04) as has_none from lineitem where l_tax > 0.03 group by all),
o as (select o_orderkey as k, o_orderkey % 4 as n, o_orderkey % 3 > 0 or o_orderkey % 5 = 0 as filled from orders)
select 'payment_history_semantics' as "check", cast(k as varchar) as key, code from (
  select o.k, 'payment_history_flag_mismatch' as code from o join sig using (k) where (case when n <> 3 then n > 0 end) is distinct from (case when has_real then true when has_none then false end)
  union all select o.k, 'payment_placeholder_flag_mismatch' from o join sig using (k) where (case when n <> 1 then n = 2 end) is distinct from has_none
  union all select o.k, 'placeholder_payment_rollup_conflict' from o left join sig using (k) where (coalesce(has_none, false) or n = 2) and filled)""",
    "field_presence": f"with {_PRESENCE} select field, num, den, {_RATE} as rate from presence",
    "profile_snapshot": f"with {snapshot_sql(None, 'm')} select metric, num, den, {_RATE} as rate from m",
    "run_failures": """with s as (select l_orderkey as o_orderkey, bool_or(l_discount > 0.09) as f, bool_or(l_discount <= 0.09 and l_tax > 0.07) as b from lineitem group by all)
select o_orderpriority, count(*) as n, round(count(*) filter (where o_orderstatus = 'P') / count(*), 4) as run_failed, round(count(*) filter (where f) / count(*), 4) as stage_failed,
       round(count(*) filter (where b) / count(*), 4) as stage_blocked from orders left join s using (o_orderkey) group by all""",
    "dossier_match": """with m as (
  select l_orderkey as txn, l_orderkey * 1000 + l_linenumber * 100 + l_partkey % 100 as match_id, l_tax > 0.06 as is_primary, case when l_quantity > 5 then round(1 - cast(l_discount as double), 2) end as confidence,
         case when l_quantity > 25 then l_linenumber end as match_rank from lineitem)
select txn, match_id, is_primary, confidence from (
  select *, row_number() over (partition by txn order by is_primary desc, confidence desc nulls last, match_rank nulls last, match_id) as n from m) where n = 1""",
    "sale_signals": _CONTEXT + "select * from sig",
    "area_signals": _CONTEXT + """select area, count(*) as n, count(*) filter (where has_permit) as n_permit, count(*) filter (where has_appeal) as n_appeal, count(*) filter (where has_gap) as n_gap,
  round(count(*) filter (where has_permit) / count(*), 4) as permit_rate, round(count(*) filter (where has_appeal) / count(*), 4) as appeal_rate, round(count(*) filter (where has_gap) / count(*), 4) as gap_rate
from sig where has_year group by all""",
    "peer_context": f"""with {FACT}
select a.parcel_id, a.yr, case when b.v > 0 then round((cast(a.v as double) - cast(b.v as double)) / cast(b.v as double), 6) end as change, case when a.yr >= 1994 then a.muni end as muni, case when a.yr >= 1994 then a.v end as v
from fact a left join fact b on b.parcel_id = a.parcel_id and b.yr = a.yr - 1""",
    "characteristics": f"with {_CHARACTERISTICS} select * exclude (p_brand, others) from e where complete > 0",
    "best_characteristics": f"with {_CHARACTERISTICS} select p_brand, page_id, complete from (select *, row_number() over (partition by p_brand order by complete desc, page_id % 37 desc, page_id desc) as n from e where complete > 0) where n = 1",
    "latest_lineage": """select parcel_id, related, kind, o_orderkey from (
  select o_custkey as parcel_id, l_partkey as related, o_orderpriority as kind, o_orderkey, row_number() over (partition by o_custkey, l_partkey, o_orderpriority order by o_orderdate desc, o_orderkey desc) as n
  from orders join lineitem on l_orderkey = o_orderkey) where n = 1""",
    "parcel_scope": f"with {FACT}, {SALE} select parcel_id, yr, v from fact where parcel_id in (select parcel_id from sale where st = 'P')",
    "resolved_events": """with d as (select p_partkey // 2 as num, count(distinct p_partkey) as n, min(p_partkey) as id from part where p_partkey % 3 <> 0 group by all),
f as (select p_partkey + 1 as num, count(distinct p_partkey) as n, min(p_partkey) as id from part group by all)
select o_orderkey, case when o_orderstatus = 'P' then o_custkey when d.n = 1 then d.id when d.n is null and f.n = 1 then f.id end as resolved
from orders left join d on d.num = o_custkey left join f on f.num = o_custkey""",
    "parse_outcomes": "select page_id, page_id % 10 = 3 as failed, case when page_id % 10 = 3 then 'AssertionError' end as error from pages",
    "feature_flags": f"""{v._SELECTED},
r as (
  select f.parcel_id, f.yr, txn, case when price > 0 then round(cast(v as double) / cast(price as double), 6) end as ratio,
         case when v is null then 'missing_assessment' when price is null then 'missing_sale' when price <= 0 then 'invalid_sale' end as flag
  from fact f left join chosen c on c.parcel_id = f.parcel_id and c.yr = f.yr)
select parcel_id, yr, concat_ws(',', case when yr < 1994 then 'early_year' end, case when ratio > 2 then 'high_ratio' end, flag) as flags, txn from r""",
}
