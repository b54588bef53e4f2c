"""Queries over tax pages: orders play pages of tax details, their lines the rows of their tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.runtime import table
from lotlens.sources import tax_pages


def _row(tag: str, *cells: Column) -> Column:
    return F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>"))], F.lit("</tr>"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, html): a heading with the year, then tax values, amounts, installments and payments."""
    t = lambda text: F.lit(text)
    # lines that share number and price keep the order of their table, which is where the SQL's ORDER BY ends
    line = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.struct(
            F.col("l_linenumber").alias("n"), F.col("l_extendedprice").alias("price"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"), F.col("l_linestatus").alias("ls"), F.col("l_returnflag").alias("rf"),
            F.col("l_quantity").cast("int").cast("string").alias("q"), F.col("l_extendedprice").cast("decimal(14,2)").cast("string").alias("p"), F.to_date("l_shipdate").cast("string").alias("d"),
        ).alias("x"),
    )
    of = line.groupBy("o_orderkey").agg(F.sort_array(F.collect_list("x")).alias("x"))
    both = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("y"), F.col("o_totalprice").cast("decimal(14,2)").cast("string").alias("total"), F.col("o_orderstatus").alias("st")).join(of, "o_orderkey")
    named = lambda text, x: F.concat(t(text), x["n"].cast("string"))
    rows = {
        "values": lambda x: F.when(x["ls"] == "O", _row("td", named("Class ", x), x["q"], x["p"])), "rates": lambda x: F.when(x["ls"] == "F", _row("td", F.concat(named("Rate ", x), t(":")), x["q"])),
        "cities": lambda x: F.when(x["rf"] == "A", _row("td", named("City ", x), F.concat(t("$"), x["p"]))), "specials": lambda x: F.when(x["rf"] == "R", _row("td", named("Sewer ", x), x["q"])),
        "payments": lambda x: _row("td", x["d"], x["p"]),
    }
    all_of = lambda name: F.array_join(F.transform("x", rows[name]), "")
    html = F.concat(
        t("<h3>Tax Details "), F.when(F.col("st") != "P", F.col("y")).otherwise("of old"), t("</h3><table>"), _row("td", t("Tax Values")), _row("th", t("Category"), t("Land"), t("Total")), all_of("values"),
        _row("td", t("School Levy Tax Credit:"), F.concat(t("$"), F.col("total"))), all_of("rates"), _row("td", F.concat(t("Tax Amounts for "), F.col("y"))), _row("th", t("Jurisdiction"), t("Amount")), all_of("cities"),
        _row("td", t("Total Taxes:"), F.col("total")), _row("th", t("Specials"), t("Amount")), F.when(F.col("st") == "F", _row("td", t("No specials"), t("$5.00"))).otherwise(all_of("specials")),
        _row("td", t("Installment Amounts")), _row("td", t("Total Due:"), F.concat(t("due "), F.col("total"))), _row("td", F.concat(t("Tax Payments for "), F.col("y"))), _row("th", t("Date of Payment"), t("Amount"), t("Receipt")), all_of("payments"), t("</table>"),
    )
    return both.select(F.col("o_orderkey").alias("page_id"), html.alias("html"))


def tax_detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regrouped details of each page as texts."""
    found = tax_pages.tax_details_of_pages(_pages(spark, sf_dir), "tax details")
    text = lambda name, *keys: F.array_join(F.transform(name, lambda r: F.concat_ws("=", *[r[k] for k in keys])), ";").alias(name)
    labelled = ["tax_rate_rows", "tax_credit_rows", "installment_rows"]
    summary = lambda k: F.try_element_at("tax_amount_summary", F.lit(k)).alias(k)
    return found.select(
        "page_id", "year", text("tax_value_rows", "Category", "Land", "Total"), *[text(x, "label", "amount") for x in labelled], text("tax_jurisdiction_rows", "Jurisdiction", "Amount"), text("special_charge_rows", "Specials", "Amount"),
        summary("total_taxes"), summary("installment_total_due"), "has_tax_credits", "has_special_charges", "has_other_tax_items",
    )


def tax_detail_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of each page with their padded receipts."""
    found = tax_pages.detail_payments_of_pages(_pages(spark, sf_dir), "tax details")
    d = F.col("data")
    return found.groupBy("page_id", "year", "source").agg(F.count("*").alias("n"), F.min(d["Date of Payment"]).alias("first"), F.sum(d["Amount"].cast("decimal(14,2)")).alias("total"), F.count_if(d["Receipt"] == "").alias("n_blank"))


QUERIES = {f.__name__: f for f in (tax_detail_pages, tax_detail_payments)}

_PAGES = """o as (
  select o_orderkey as page_id, case when o_orderstatus <> 'P' then year(o_orderdate) end as year, cast(cast(o_totalprice as decimal(14,2)) as varchar) as total, o_orderstatus as st from orders
  where o_orderkey in (select l_orderkey from lineitem)),
l as (
  select l_orderkey as page_id, l_linenumber as n, l_linestatus as ls, l_returnflag as rf, cast(cast(l_quantity as int) as varchar) as q, cast(cast(l_extendedprice as decimal(14,2)) as varchar) as p, cast(cast(l_shipdate as date) as varchar) as d, l_extendedprice as price from lineitem)"""

SQL = {
    "tax_detail_pages": f"""with {_PAGES},
g as (
  select page_id, string_agg('Class ' || n || '=' || q || '=' || p, ';' order by n, price) filter (where ls = 'O') as v, string_agg('Rate ' || n || '=' || q, ';' order by n, price) filter (where ls = 'F') as r,
         string_agg('City ' || n || '=$' || p, ';' order by n, price) filter (where rf = 'A') as c, string_agg('Sewer ' || n || '=' || q, ';' order by n, price) filter (where rf = 'R') as s from l group by page_id)
select o.page_id, year, coalesce(v, '') as tax_value_rows, coalesce(r, '') as tax_rate_rows, 'School Levy Tax Credit=$' || total as tax_credit_rows, 'Total Due=due ' || total as installment_rows, coalesce(c, '') as tax_jurisdiction_rows,
       case when st = 'F' then 'No specials=$5.00' else coalesce(s, '') end as special_charge_rows, total as total_taxes, 'due ' || total as installment_total_due, true as has_tax_credits,
       st <> 'F' and s is not null as has_special_charges, false as has_other_tax_items
from o join g on g.page_id = o.page_id""",
    "tax_detail_payments": f"""with {_PAGES}
select o.page_id, year, 'tax_detail_payments' as source, count(*) as n, min(d) as first, sum(cast(p as decimal(14,2))) as total, count(*) as n_blank from o join l on l.page_id = o.page_id group by o.page_id, year""",
}
