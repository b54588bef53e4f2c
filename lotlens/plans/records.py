"""Queries on entity match, text keys, parsing, dossiers, pages and imports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.functions import parsing as P
from lotlens.functions import text as T
from lotlens.operators import dossier, match, review
from lotlens.plans import scoring
from lotlens.plans.base import FACT, SALE, fact, sale
from lotlens.runtime import cut, scratch, table
from lotlens.sources import imports, pages
from lotlens.sources.tables import KeyedTable


def _left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions with four keys: customer number as text, a coarse number, an address that some customers share, a legal description."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = orders.join(customer, "o_custkey")
    lot = F.concat(F.lit("Lot TWO ("), (F.col("o_custkey") % 301).cast("string"), F.lit("), Block 3, Second Addition to The "), F.col("c_mktsegment"), F.lit("; in the town"))
    return rows.select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit(" sup/"), F.col("o_custkey").cast("string"))).alias("k1"),
        F.when(F.col("o_totalprice") > 150000, F.concat(F.lit("S "), (F.col("o_custkey") % 997).cast("string"))).alias("k2"),
        F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("n-"), F.expr("o_custkey div 10").cast("string"))).alias("k3"), F.when(F.col("o_custkey") % 7 != 0, lot).alias("k4"), "c_mktsegment",
    )


def _right(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    return supplier.select(
        "s_suppkey", F.concat(F.lit("SUP."), key).alias("r1"), F.concat(F.lit("S"), key).alias("r2"), F.concat(F.lit("N_"), F.expr("s_suppkey div 2").cast("string")).alias("r3"),
        F.concat(F.lit("building block 3 lot "), F.expr("s_suppkey div 2").cast("string")).alias("r4"),
    )


def _tiers() -> list:
    key = lambda c: T.parcel_key(F.col(c))
    keys = [(key("k1"), key("r1")), (key("k2"), key("r2")), (key("k3"), key("r3")), (T.sale_legal_key(F.col("k4")), T.parcel_legal_key(F.col("r4")))]
    return [(method, worth, *pair) for (method, worth), pair in zip(match.TIERS.items(), keys, strict=True)]


def entity_match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.cascade(_left(spark, sf_dir), _right(spark, sf_dir), "o_orderkey", "s_suppkey", _tiers())


def unique_match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = [(name, left, [right]) for name, _, left, right in _tiers()]
    return match.unique_cascade(_left(spark, sf_dir), _right(spark, sf_dir), "o_orderkey", "s_suppkey", tiers)


def match_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of all orders against those of an earlier run that knew the dear orders only, at other confidences."""
    new = cut(entity_match_cascade(spark, sf_dir))  # compared with what is derived from it
    dear = table(spark, sf_dir, "orders").where("o_totalprice > 100000").select("o_orderkey")
    old = new.join(dear, "o_orderkey", "left_semi").withColumn("confidence", F.when(F.col("method") == "parcel_number_crosswalk", 0.9).otherwise(F.col("confidence")))
    old = old.withColumn("s_suppkey", F.when(F.col("method") == "exact_parcel_number", F.col("s_suppkey") + 1).otherwise(F.col("s_suppkey")))
    return match.sync(new, old, ["o_orderkey", "s_suppkey", "method"], ["confidence", "match_rank"])


def exclusion_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = scoring.sale_exclusions(spark, sf_dir)
    dear = table(spark, sf_dir, "orders").where("o_totalprice > 100000").select("o_orderkey")
    old = new.join(dear, "o_orderkey", "left_semi").unionByName(dear.select("o_orderkey", F.lit("retired_code").alias("exclusion_code")))
    old = old.withColumn("is_active", F.col("o_orderkey") % 3 != 0)
    return match.flag_sync(new, old, ["o_orderkey", "exclusion_code"])


def match_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, methods, tiers and the review queue of all orders, each class of the queue with its first three ids."""
    found = cut(entity_match_cascade(spark, sf_dir))  # read for the best match and for the number of candidates
    state = F.when(F.col("o_orderstatus") == "P", "reviewed").when(F.col("o_orderkey") % 2 == 0, "needs_review")
    return match.audit(table(spark, sf_dir, "orders").select("o_orderkey", state.alias("review_status")), found, "o_orderkey")


def review_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = entity_match_cascade(spark, sf_dir).groupBy("o_orderkey").agg(F.count("*").alias("n"), F.max("confidence").alias("best"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(found, "o_orderkey", "left")
    status = F.when(F.col("o_orderstatus") == "P", "reviewed")
    return rows.select("o_orderkey", match.review_outcome(F.coalesce(status, F.lit("unreviewed")), F.coalesce("n", F.lit(0)), F.col("best")).alias("outcome"))


def sale_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each municipality: sales, those with a fact in their year, with a price gap, and rates; municipality of the sale's year, else the newest."""
    f = fact(spark, sf_dir)
    newest = f.groupBy("parcel_id").agg(F.max_by("muni", "yr").alias("newest"))
    rows = sale(spark, sf_dir).join(f.select("parcel_id", "yr", "muni", "v"), ["parcel_id", "yr"], "left").join(newest, "parcel_id", "left")
    rows = rows.select(F.coalesce("muni", "newest", F.lit("UNKNOWN")).alias("area"), F.col("v").isNotNull().alias("has_fact"), P.price_gap_flag(F.col("price"), F.col("v")).alias("gap"))
    n = F.count("*")
    return rows.groupBy("area").agg(n.alias("n"), F.count_if("has_fact").alias("n_fact"), F.count_if("gap").alias("n_gap"), F.round(F.count_if("has_fact") / n, 4).alias("fact_rate"), F.round(F.count_if("gap") / n, 4).alias("gap_rate"))


def context_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts within two years of each sale, or the newest five of its parcel; an equi-join on the parcel first."""
    near = match.context_years(_early(sale(spark, sf_dir)), fact(spark, sf_dir).select("parcel_id", "yr", "v"))
    return near.groupBy("txn").agg(F.count("*").alias("n"), F.min("fact_yr").alias("first"), F.max("fact_yr").alias("last"), F.sum("v").alias("total"))


def _early(sales: DataFrame) -> DataFrame:
    """Every seventh sale moved to a year without facts."""
    return sales.withColumn("yr", F.when(F.col("txn") % 7 == 0, F.col("yr") - 20).otherwise(F.col("yr")))


def normalize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text keys of strings made from customers and their nations."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    k = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    number = F.concat(F.lit(" ab. "), F.substring(k, 1, 3), F.lit("/"), k, k, F.lit("-_ "))
    area = F.regexp_replace("n_name", "_", " ")
    address = F.concat(k, F.lit("  north "), area, F.when(F.col("c_acctbal") > 0, " Avenue").otherwise(" Court"), F.lit(" #"), (F.col("c_custkey") % 50).cast("string"), F.when(F.col("c_acctbal") > 3000, ", Madison, WI 53703").otherwise(" "))
    legal = F.concat(F.lit("Lot "), (F.col("c_custkey") % 40).cast("string"), F.when(F.col("c_acctbal") > 5000, ", Block TWO (2)").otherwise(""), F.lit(", First Addition to The "), area, F.lit("; rest"))
    own = F.concat(area, F.lit(" BLOCK 2, LOT "), (F.col("c_custkey") % 40).cast("string"))
    return c.select(
        "c_custkey", T.parcel_key(number).alias("parcel_key"), T.crosswalk_key(number).alias("crosswalk"), T.site_address_key(address).alias("site"), T.sale_address_key(address).alias("sale_address"),
        T.sale_legal_key(legal).alias("sale_legal"), T.parcel_legal_key(own).alias("parcel_legal"), T.canonical_text(F.col("c_mktsegment")).alias("segment"),
        T.segment_key(F.concat(F.lit("--"), F.col("n_name"), F.lit(" / "), F.col("c_mktsegment"), F.lit("!!"))).alias("segment_key"),
        T.boolean_token(F.when(F.col("c_acctbal") > 0, " Yes").when(F.col("c_acctbal") < -500, "0").otherwise("maybe")).alias("flag"),
        T.stable_id("evt_", F.col("c_name"), F.col("c_mktsegment")).alias("stable"),
    )


def parse_dates_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, years and amounts printed in several forms and parsed again."""
    e = table(spark, sf_dir, "events")
    form = F.col("event_id") % 5
    day = F.when(form == 0, F.date_format("ts", "MM/dd/yyyy")).when(form == 1, F.date_format("ts", "M-d-yyyy")).when(form == 2, F.date_format("ts", "yyyy-MM-dd HH:mm")).when(form == 3, F.date_format("ts", "M/d/yy")).otherwise(F.concat(F.lit("day "), F.date_format("ts", "dd")))
    cents = F.round("value", 2).cast("decimal(14,2)")
    amount = F.when(form == 0, F.concat(F.lit("$1,"), F.lpad(cents.cast("string"), 6, "0"))).when(form == 1, F.concat(F.lit("("), cents.cast("string"), F.lit(")"))).when(form == 2, F.lit("1e3")).otherwise(cents.cast("string"))
    year = F.when(form == 0, F.date_format("ts", "yyyy")).when(form == 1, F.lit("tax year 2023")).when(form == 2, F.lit("2022/2023")).otherwise(F.lit("x"))
    return e.select("event_id", P.flexible_date(day).alias("day"), P.money(amount).cast("double").alias("amount"), P.year_number(year).alias("year"), P.year_number(year, one_token=True).alias("tax_year"))


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses, outcomes and clamped values from order fields."""
    o = table(spark, sf_dir, "orders")
    p = F.substring("o_orderpriority", 1, 1)
    status = F.when(p == "1", " Approved").when(p == "2", "VOID").when(p == "3", "other").when(p == "4", "").otherwise("Final")
    outcome = F.when(p == "1", "Reduction  Granted in part").when(p == "2", "denied; partial reduction").when(p == "3", "Partially granted").when(p == "4", "dismissed").otherwise("open")
    held, over = P.clamped(F.col("o_totalprice"), 7, 2)
    return o.select("o_orderkey", P.permit_status(status).alias("status"), P.appeal_outcome(outcome).alias("outcome"), held.cast("double").alias("held"), over.alias("over"), P.filled(F.nullif(status, F.lit("")), F.nullif(outcome, F.lit("open"))).alias("filled"))


def _timeline_events(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    line = table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate")
    permits = line.where("l_returnflag = 'A'")
    f = fact(spark, sf_dir)
    none = F.lit(None).cast("date")
    return [
        dossier.event(f, "assessment", F.col("parcel_id"), F.col("yr"), none, F.col("yr"), F.col("v")),
        dossier.event(sale(spark, sf_dir), "sale", F.col("parcel_id"), F.col("txn"), none, F.col("yr"), F.col("price")),
        dossier.event(permits, "permit", F.col("l_partkey"), F.col("l_orderkey") * 10 + F.col("l_linenumber"), F.when(F.col("l_quantity") > 10, F.to_date("l_shipdate")), year, F.col("l_extendedprice")),
    ]


def parcel_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dossier.timeline(*_timeline_events(spark, sf_dir)).select("parcel_id", "event_type", "event_date", "event_year", "position", F.round("amount", 2).alias("amount"))


def dossier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, c = _timeline_events(spark, sf_dir)
    return dossier.section_summary(a.unionByName(b).unionByName(c))


def investigation_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest scores with dossier counts and the latest review, users playing reviewers."""
    scores = scoring.rule_scores(spark, sf_dir).select("parcel_id", "yr", "score")
    top = review.queue(scores, [F.desc("score"), F.asc("parcel_id"), F.asc("yr")], 10)
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("parcel_id"), "event_id", "ts", "event_type")
    last = review.latest_review(events, "parcel_id", "ts", "event_id").select("parcel_id", F.col("event_type").alias("review"))
    return dossier.investigation_set(top, dossier_summary(spark, sf_dir), last, "parcel_id")


def year_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in scope of two years by their own year if it is known, else by dates of their lines."""
    line = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    rows = table(spark, sf_dir, "orders").join(line, "o_orderkey", "left")
    own = F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate"))
    return rows.where(dossier.in_years(own, [F.col("a"), F.col("b")], [1996, 1997])).select("o_orderkey")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.links(pages.extract(table(spark, sf_dir, "pages")))
    return found.groupBy("page_id").agg(F.count("*").alias("n_links"), F.countDistinct("href").alias("n_targets"))


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages built from part-years as tables: header tables become records, two-cell rows key and value pairs, blanks are filled."""
    f = fact(spark, sf_dir)
    row = F.concat(F.lit("<tr><td>"), F.when(F.col("yr") % 2 == 0, F.col("yr").cast("string")).otherwise(""), F.lit("</td><td>$"), F.col("v").cast("string"), F.lit("</td></tr>"))
    html = f.groupBy("parcel_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("yr", row.alias("h")))), lambda x: x["h"]), "").alias("rows"), F.min("muni").alias("muni"))
    head = "<h2>Assessment History</h2><table><tr><th>Year</th><th>Value</th></tr>"
    html = html.select(F.col("parcel_id").alias("page_id"), F.concat(F.lit("<table><tr><td>Owner Area:</td><td>"), "muni", F.lit(f"</td></tr></table>{head}"), "rows", F.lit("</table>")).alias("html"))
    long = cut(pages.extract(html), "zstd")  # read for heads, cells and pairs
    records = pages.table_records(long, "assessment history")
    rows = records.select("page_id", "row", F.col("data")["Year"].alias("year"), P.page_money(F.col("data")["Value"]).alias("value"))
    filled = pages.forward_fill(rows, ["page_id"], ["row"], "year")
    summary = pages.summary_fields(pages.key_values(long), {"area": ["Area", "Owner Area"]})
    return filled.groupBy("page_id").agg(F.count("*").alias("n"), F.countDistinct("year").alias("n_years"), F.sum("value").cast("decimal(16,2)").alias("total")).join(summary, "page_id")


#: Rows of one CSV file: a file is read by one task, so the size of files bounds a task's memory, and their number gives the tasks.
CSV_ROWS = 50_000


def _csv_folder(spark: SparkSession, rows: DataFrame, name: str) -> str:
    folder = scratch(spark, f"csv-{name}")
    rows.write.option("header", True).option("maxRecordsPerFile", CSV_ROWS).csv(folder)
    return folder


def csv_import_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV files by Spark and imported: status and reason of each row."""
    o = table(spark, sf_dir, "orders")
    day = F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    rows = o.select(
        day.alias("Sale Date"), F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("Sale Price"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("PIN"),
        F.lit("n").alias("Arms Length"), F.col("o_orderkey").cast("string").alias("Document Number"),
    )
    got = imports.import_sales(spark, _csv_folder(spark, rows, "sales"))
    return got.select(F.col("document_number_raw").cast("long").alias("o_orderkey"), "import_status", "rejection_reason", "transfer_date", F.col("consideration").cast("double").alias("price"), "arms_length")


def _imported_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    rows = line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("permit #"), F.when(F.col("l_quantity") > 5, F.col("l_partkey").cast("string")).otherwise("n/a").alias("Parcel_Number:"),
        F.when(F.col("l_returnflag") == "A", "Issued").otherwise("strange").alias("Status"), F.when(F.col("l_tax") > 0.02, F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise("soon").alias("Issued Date"),
        F.when(F.col("l_discount") > 0.03, "2001").alias("Permit Year"), F.concat(F.lit("("), F.col("l_extendedprice").cast("decimal(14,2)").cast("string"), F.lit(")")).alias("Estimated Cost"),
    )
    return imports.import_permits(spark, _csv_folder(spark, rows, "permits"))


def csv_import_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _imported_permits(spark, sf_dir)
    return got.select(F.col("permit_number_raw").alias("number"), "import_status", "rejection_reason", F.array_join("import_warnings", ",").alias("warnings"), "permit_year", "status_norm", F.col("estimated_cost").cast("double").alias("cost"))


def import_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.import_summary(_imported_permits(spark, sf_dir))


def csv_import_appeals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rows = o.select(
        F.col("o_orderkey").cast("string").alias("Case Number"), F.lit("7").alias("PIN"), F.when(F.col("o_orderstatus") == "F", "Denied").when(F.col("o_orderstatus") == "O", "partial reduction").alias("Decision"),
        F.concat(F.lit("TY "), F.year("o_orderdate").cast("string")).alias("Tax Year"), F.date_format("o_orderdate", "M/d/yyyy").alias("Filing Date"), F.lit("100,000").alias("Assessed Value"),
        F.col("o_totalprice").cast("decimal(14,2)").cast("string").alias("Final Value"),
    )
    got = imports.import_appeals(spark, _csv_folder(spark, rows, "appeals"))
    return got.select(F.col("appeal_number_raw").cast("long").alias("o_orderkey"), "import_status", "outcome_norm", "tax_year", F.col("value_change").cast("double").alias("change"), F.array_join("import_warnings", ",").alias("warnings"))


def upsert_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales files imported, and imported again, into one table: the second time updates each row and inserts none."""
    o = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "MM/dd/yyyy").alias("Sale Date"), F.col("o_totalprice").cast("decimal(14,2)").cast("string").alias("Sale Price"), F.col("o_orderkey").cast("string").alias("PIN"))
    rows = imports.import_sales(spark, _csv_folder(spark, o, "upsert")).select("sha256", "row_number", "parcel_number_norm", "consideration", "import_status")
    target = KeyedTable(spark, scratch(spark, "sales"), ["sha256", "row_number"], buckets=8)
    target.upsert(rows)
    counts = target.upsert(rows).counts
    found = target.read().select(F.col("parcel_number_norm").cast("long").alias("o_orderkey"), F.col("consideration").cast("double").alias("price"), "import_status")
    return found.withColumns({k: F.lit(n).cast("long") for k, n in counts.items()})


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event settings written as JSON artifacts and read back with a schema and the path they came from."""
    folder = scratch(spark, "json")
    table(spark, sf_dir, "events").select("event_type", "user_id", F.struct(F.get_json_object("props", "$.k").cast("long").alias("k")).alias("settings")).write.partitionBy("event_type").json(folder)
    read = spark.read.schema("user_id long, settings struct<k: long>, _corrupt_record string").option("mode", "PERMISSIVE").json(folder + "/*")
    rows = read.withColumn("kind", F.regexp_extract(F.input_file_name(), "event_type=([a-z]+)", 1))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.sum("settings.k").alias("k"))


_SIDES = """l as (
  select o_orderkey, case when o_orderpriority = '1-URGENT' then 'SUP' || o_custkey end as k1, case when o_totalprice > 150000 then 'S' || (o_custkey % 997) end as k2, case when o_custkey % 2 = 0 then 'N' || (o_custkey // 10) end as k3,
         case when o_custkey % 7 <> 0 then c_mktsegment || '|' || (o_custkey % 301) end as k4
  from orders join customer on c_custkey = o_custkey),
r as (select s_suppkey, 'SUP' || s_suppkey as r1, 'S' || s_suppkey as r2, 'N' || (s_suppkey // 2) as r3, 'BUILDING|' || (s_suppkey // 2) as r4 from supplier)"""

_HITS = f"""{_SIDES},
h as (
  select o_orderkey, s_suppkey, 0 as level, 'exact_parcel_number' as method, 1.0 as confidence from l join r on k1 = r1 union all
  select o_orderkey, s_suppkey, 1, 'parcel_number_crosswalk', 0.95 from l join r on k2 = r2 union all select o_orderkey, s_suppkey, 2, 'normalized_address', 0.9 from l join r on k3 = r3
  union all select o_orderkey, s_suppkey, 3, 'normalized_legal_description', 0.8 from l join r on k4 = r4),
f as (select *, min(level) over (partition by o_orderkey) as first from h),
m as (
  select o_orderkey, s_suppkey, method, cast(confidence as double) as confidence, row_number() over (partition by o_orderkey order by s_suppkey) as match_rank, count(*) over (partition by o_orderkey) as n from f where level = first),
found as (select o_orderkey, s_suppkey, method, confidence, match_rank, n = 1 and confidence >= 0.85 as is_primary, case when n = 1 and confidence >= 0.85 then 'auto_accepted' else 'needs_review' end as review_status from m)"""

_EXCL = scoring.SQL["sale_exclusions"]

_TIMELINE = f"""{FACT}, {SALE},
ev as (
  select parcel_id, 'assessment' as event_type, cast(yr as bigint) as row_id, make_date(yr, 1, 1) as event_date, yr as event_year, cast(v as double) as amount, 5 as r from fact
  union all select parcel_id, 'sale', txn, make_date(yr, 1, 1), yr, cast(price as double), 4 from sale
  union all select l_partkey, 'permit', l_orderkey * 10 + l_linenumber, case when l_quantity > 10 then cast(l_shipdate as date) else make_date(year(l_shipdate), 1, 1) end, year(l_shipdate), l_extendedprice, 3
  from lineitem where l_returnflag = 'A')"""

QUERIES = {f.__name__: f for f in (
    entity_match_cascade, unique_match_cascade, match_sync, exclusion_sync, match_audit, review_outcomes, sale_context, context_sample, normalize_keys, parse_dates_money, codes, parcel_timeline,
    dossier_summary, investigation_set, year_scope, page_links, page_records, csv_import_sales, csv_import_permits, import_summary, csv_import_appeals, upsert_import, json_scan,
)}

_SUMMARY = """select parcel_id, event_type, count(*) as n, min(event_year) as first_year, max(event_year) as last_year, count(event_date) as n_dated, round(sum(amount) filter (where amount > 0), 2) as amount from ev group by all"""

_PERMIT_ROWS = """p as (
  select l_orderkey || '-' || l_linenumber || '-' || l_partkey as number, l_quantity > 5 as located, l_tax > 0.02 as dated, year(l_shipdate) as y, l_discount > 0.03 as said, l_returnflag = 'A' as issued,
         -cast(cast(l_extendedprice as decimal(14,2)) as double) as cost from lineitem),
q as (
  select number, case when not located then 'no_locator' when not said and not dated then 'no_temporal_anchor' end as rejection_reason,
         concat_ws(',', case when not dated then 'issued_date_unparseable' end, case when said and dated and y <> 2001 then 'permit_year_mismatch' end) as warnings,
         case when said then 2001 when dated then y end as permit_year, case when issued then 'issued' else 'unknown' end as status_norm, cost from p),
imported as (select *, case when rejection_reason is null then 'loaded' else 'rejected' end as import_status from q)"""

SQL = {
    "entity_match_cascade": f"with {_HITS} select * from found",
    "unique_match_cascade": f"""with {_SIDES},
i1 as (select r1 as k, min(s_suppkey) as s from r group by r1 having count(distinct s_suppkey) = 1), i2 as (select r2 as k, min(s_suppkey) as s from r group by r2 having count(distinct s_suppkey) = 1),
i3 as (select r3 as k, min(s_suppkey) as s from r group by r3 having count(distinct s_suppkey) = 1), i4 as (select r4 as k, min(s_suppkey) as s from r group by r4 having count(distinct s_suppkey) = 1)
select o_orderkey, coalesce(i1.s, i2.s, i3.s, i4.s) as s_suppkey,
       case when i1.s is not null then 'exact_parcel_number' when i2.s is not null then 'parcel_number_crosswalk' when i3.s is not null then 'normalized_address' else 'normalized_legal_description' end as method
from l left join i1 on k1 = i1.k left join i2 on k2 = i2.k left join i3 on k3 = i3.k left join i4 on k4 = i4.k where coalesce(i1.s, i2.s, i3.s, i4.s) is not null""",
    "match_sync": f"""with {_HITS},
o as (
  select o_orderkey, case when method = 'exact_parcel_number' then s_suppkey + 1 else s_suppkey end as s_suppkey, method, case when method = 'parcel_number_crosswalk' then 0.9 else confidence end as confidence, match_rank
  from found where o_orderkey in (select o_orderkey from orders where o_totalprice > 100000))
select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey, coalesce(n.s_suppkey, o.s_suppkey) as s_suppkey, coalesce(n.method, o.method) as method,
       case when o.o_orderkey is null then 'insert' when n.o_orderkey is null then 'delete' when n.confidence = o.confidence and n.match_rank = o.match_rank then 'keep' else 'update' end as action
from found n full join o on n.o_orderkey = o.o_orderkey and n.s_suppkey = o.s_suppkey and n.method = o.method""",
    "exclusion_sync": f"""with n as materialized ({_EXCL}), d as materialized (select o_orderkey from orders where o_totalprice > 100000),
o as materialized (select * from n where o_orderkey in (select o_orderkey from d) union all select o_orderkey, 'retired_code' from d)
select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey, coalesce(n.exclusion_code, o.exclusion_code) as exclusion_code, n.o_orderkey is not null as is_active,
       case when o.o_orderkey is null then 'insert' when n.o_orderkey is null then case when o.o_orderkey % 3 <> 0 then 'deactivate' else 'none' end
            when o.o_orderkey % 3 <> 0 then 'keep' else 'reactivate' end as action from n full join o on n.o_orderkey = o.o_orderkey and n.exclusion_code = o.exclusion_code""",
    "match_audit": f"""with {_HITS},
b as (select *, row_number() over (partition by o_orderkey order by is_primary desc, match_rank, confidence desc) as k, count(*) over (partition by o_orderkey) as c from found),
a as (
  select o.o_orderkey, case when o_orderstatus = 'P' then 'reviewed' when o.o_orderkey % 2 = 0 then 'needs_review' end as st, method, confidence, c, method is not null as matched from orders o left join b on b.o_orderkey = o.o_orderkey and k = 1),
e as (
  select o_orderkey, 'totals' as section, case when matched then 'matched' else 'unmatched' end as name from a union all select o_orderkey, 'review_status', st from a where st is not null
  union all select o_orderkey, 'method', method from a where matched
  union all select o_orderkey, 'tier', case when confidence is null then 'unknown' when confidence >= 0.95 then 'high' when confidence >= 0.85 then 'medium' else 'low' end from a where matched
  union all select o_orderkey, 'queue', 'unresolved' from a where not matched and st = 'needs_review' union all select o_orderkey, 'queue', 'ambiguous' from a where matched and c > 1 and st = 'needs_review'
  union all select o_orderkey, 'queue', 'low_confidence' from a where matched and confidence < 0.85 and st = 'needs_review'),
n as (select *, row_number() over (partition by section, name order by o_orderkey) as k from e)
select section, name, count(*) as n, case when section = 'queue' then string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey) filter (where k <= 3) end as sample_ids from n group by section, name""",
    "review_outcomes": f"""with {_HITS}, g as (select o_orderkey, count(*) as n, max(confidence) as best from found group by all)
select o.o_orderkey, case when o_orderstatus = 'P' then 'reviewed' when coalesce(n, 0) = 0 then 'unresolved' when n > 1 then 'ambiguous' when best < 0.85 then 'low_confidence' else 'unreviewed' end as outcome
from orders o left join g on g.o_orderkey = o.o_orderkey""",
    "sale_context": f"""with {FACT}, {SALE}, w as (select parcel_id, arg_max(muni, yr) as newest from fact group by all),
r as (
  select coalesce(f.muni, newest, 'UNKNOWN') as area, f.v is not null as has_fact, coalesce(f.v > 0 and (cast(price as double) / cast(f.v as double) >= 1.5 or cast(price as double) / cast(f.v as double) <= 0.5), false) as gap
  from sale s left join fact f on f.parcel_id = s.parcel_id and f.yr = s.yr left join w on w.parcel_id = s.parcel_id)
select area, count(*) as n, count(*) filter (where has_fact) as n_fact, count(*) filter (where gap) as n_gap, round(count(*) filter (where has_fact) / count(*), 4) as fact_rate, round(count(*) filter (where gap) / count(*), 4) as gap_rate from r group by area""",
    "context_sample": f"""with {FACT}, {SALE}, s as (select txn, parcel_id, case when txn % 7 = 0 then yr - 20 else yr end as yr from sale),
r as (select *, row_number() over (partition by parcel_id order by yr desc) as k from fact),
j as (select txn, r.yr as fy, r.v, k, abs(r.yr - s.yr) <= 2 as near from s join r using (parcel_id)),
w as (select *, bool_or(near) over (partition by txn) as any_near from j)
select txn, count(*) as n, min(fy) as first, max(fy) as last, sum(v) as total from w where near or (not any_near and k <= 5) group by txn""",
    "normalize_keys": """with c as (select *, lpad(cast(c_custkey as varchar), 6, '0') as k, cast(c_custkey % 50 as varchar) as u, cast(c_custkey % 40 as varchar) as lot, upper(replace(n_name, '_', ' ')) as area from customer join nation on n_nationkey = c_nationkey)
select c_custkey, 'AB' || substr(k, 1, 3) || k || k as parcel_key, 'AB' || substr(k, 1, 3) || substr(k, 1, 2) || substr(k, 4, 1) || substr(k, 3, 1) || substr(k || k, 5) as crosswalk,
       k || ' NORTH ' || area || case when c_acctbal > 0 then ' AVENUE' else ' COURT' end || ' ' || u || case when c_acctbal > 3000 then ' MADISON WI 53703' else '' end as site,
       case when c_acctbal > 3000 then k || ' N ' || area || ' AVE' else k || ' N ' || area || case when c_acctbal > 0 then ' AVE ' else ' CT ' end || u end as sale_address,
       'SUBDIVISION:' || area || '|LOT:' || lot || case when c_acctbal > 5000 then '|BLOCK:2' else '' end as sale_legal, 'SUBDIVISION:' || area || '|LOT:' || lot || '|BLOCK:2' as parcel_legal,
       lower(c_mktsegment) as segment, regexp_replace(regexp_replace('--' || n_name || ' / ' || c_mktsegment || '!!', '[^A-Za-z0-9_-]+', '_', 'g'), '^_+|_+$', '', 'g') as segment_key,
       case when c_acctbal > 0 then true when c_acctbal < -500 then false end as flag, 'evt_' || substr(sha256(c_name || '|' || c_mktsegment), 1, 20) as stable from c""",
    "parse_dates_money": """select event_id, case when event_id % 5 < 4 then cast(ts as date) end as day,
       case event_id % 5 when 0 then cast('1' || lpad(cast(cast(round(value, 2) as decimal(14,2)) as varchar), 6, '0') as double) when 1 then -cast(cast(round(value, 2) as decimal(14,2)) as double) when 2 then null
            else cast(cast(round(value, 2) as decimal(14,2)) as double) end as amount,
       case when event_id % 5 = 0 then year(ts) end as year, case event_id % 5 when 0 then year(ts) when 1 then 2023 end as tax_year from events""",
    "codes": """select o_orderkey, case substr(o_orderpriority, 1, 1) when '1' then 'issued' when '2' then 'cancelled' when '3' then 'unknown' when '4' then null else 'finaled' end as status,
       case substr(o_orderpriority, 1, 1) when '1' then 'reduction_granted' when '2' then 'denied' when '3' then 'partial_reduction' when '4' then 'dismissed' else 'pending' end as outcome,
       least(round(o_totalprice, 2), 99999.99) as held, round(o_totalprice, 2) > 99999.99 as over, case substr(o_orderpriority, 1, 1) when '4' then 1 when '5' then 1 else 2 end as filled from orders""",
    "parcel_timeline": f"""with {_TIMELINE} select parcel_id, event_type, event_date, event_year, row_number() over (partition by parcel_id order by event_date desc nulls last, r, row_id, amount desc) as position, round(amount, 2) as amount from ev""",
    "dossier_summary": f"with {_TIMELINE} {_SUMMARY}",
    "investigation_set": f"""with s as ({scoring.SQL["rule_scores"]}), t as (select parcel_id, yr, score, row_number() over (order by score desc, parcel_id, yr) as queue_rank from s),
d as (select parcel_id, count(*) as n_sections, cast(sum(n) as bigint) as n_events from (with {_TIMELINE} {_SUMMARY}) group by all),
e as (select user_id, event_type, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events)
select t.parcel_id, yr, score, queue_rank, n_sections, n_events, event_type as review from t left join d on d.parcel_id = t.parcel_id left join e on e.user_id = t.parcel_id and e.n = 1 where queue_rank <= 10""",
    "year_scope": """with l as (select l_orderkey, min(l_shipdate) as a, max(l_shipdate) as b from lineitem group by all)
select o_orderkey from orders left join l on l_orderkey = o_orderkey
where case when o_orderstatus <> 'P' then year(o_orderdate) in (1996, 1997) else coalesce(year(a) in (1996, 1997) or year(b) in (1996, 1997), false) end""",
    "page_links": """with h as (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) as href from pages) select page_id, count(*) as n_links, count(distinct href) as n_targets from h group by all""",
    "page_records": f"""with {FACT}, g as (select *, max(case when yr % 2 = 0 then yr end) over (partition by parcel_id order by yr) as filled from fact)
select parcel_id as page_id, count(*) as n, count(distinct filled) as n_years, cast(sum(v) as decimal(16,2)) as total, min(muni) as area from g group by all""",
    "csv_import_sales": """with o as (select *, o_orderpriority = '5-LOW' as bad, o_orderstatus = 'P' as bare from orders)
select o_orderkey, case when bad or bare then 'rejected' else 'loaded' end as import_status, case when bad then 'transfer_date_unparseable' when bare then 'no_identifier' end as rejection_reason,
       case when not bad then cast(o_orderdate as date) end as transfer_date, round(o_totalprice, 2) as price, false as arms_length from o""",
    "csv_import_permits": f"with {_PERMIT_ROWS} select number, import_status, rejection_reason, warnings, permit_year, status_norm, cost from imported",
    "import_summary": f"""with {_PERMIT_ROWS}, w as (select unnest(string_split(warnings, ',')) as name from imported where warnings <> '')
select 'status' as kind, import_status as name, count(*) as n from imported group by all union all select 'reason', rejection_reason, count(*) from imported where rejection_reason is not null group by all
union all select 'warning', name, count(*) from w group by all""",
    "csv_import_appeals": """with a as (select *, cast(cast(o_totalprice as decimal(14,2)) as double) - 100000 as change from orders)
select o_orderkey, 'loaded' as import_status, case o_orderstatus when 'F' then 'denied' when 'O' then 'partial_reduction' end as outcome_norm, year(o_orderdate) as tax_year, change,
       case when o_orderstatus = 'O' and change > 0 then 'increase_with_reduction_outcome' else '' end as warnings from a""",
    "upsert_import": "select o_orderkey, round(o_totalprice, 2) as price, 'loaded' as import_status, 0::bigint as inserted, (select count(*) from orders) as updated from orders",
    "json_scan": "select event_type as kind, count(*) as n, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as k from events group by all",
}
