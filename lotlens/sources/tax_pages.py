"""Tax and assessment tables of parcel pages: sections and header rows are carried down their tables together.

Input are the long rows of ``pages.extract``; a table belongs to the heading above it, which may name a year.  The functions
``..._of_pages`` start from pages: what is carried down a table stays within its page, so a page is finished where it is read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotlens.sources import pages

# Sections, labels and header words of the tables, and the names of what they become.
VALUES, AMOUNTS, INSTALLMENTS, PAYMENTS = "Tax Values", "Tax Amounts for", "Installment Amounts", "Tax Payments for"
TOTALS = {"Total Taxes": "total_taxes", "Total Taxes Less Credits": "total_taxes_less_credits", "Total Amount Due": "total_amount_due"}
CREDITS = ["LOTTERY CREDIT", "FIRST DOLLAR CREDIT"]
SCHOOL_CREDIT = "School Levy Tax Credit"
LISTS = ["tax_value_rows", "tax_rate_rows", "tax_jurisdiction_rows", "tax_credit_rows", "special_charge_rows", "other_tax_item_rows", "installment_rows"]
BY_HEADER = {"JURISDICTION": "tax_jurisdiction_rows", "SPECIALS": "special_charge_rows", "OTHER TAX ITEMS": "other_tax_item_rows"}
ZERO = ["$0.00", "0.00", "0", "$0"]
_MAP = "map<string,string>"


def _label(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, ":+$", ""))


def rows_of(long: DataFrame, heading: str) -> DataFrame:
    """(page_id, record, row, year, values, is_header): the rows of all tables below a heading that contains ``heading``.

    year is the first number of four digits in the heading, or null.
    """
    cells = long.where((F.col("kind") == "cell") & F.lower("section").contains(heading.lower()))
    rows = cells.groupBy("page_id", "record", "row").agg(F.array_sort(F.collect_list(F.struct("col", "value"))).alias("c"), F.max("is_header").alias("is_header"), F.first("section").alias("section"))
    return rows.select("page_id", "record", "row", _year(), F.transform("c", lambda x: x["value"]).alias("values"), "is_header")


def _year() -> Column:
    return F.nullif(F.regexp_extract("section", r"(?<!\d)(\d{4})(?!\d)", 1), F.lit("")).cast("int").alias("year")


def rows_of_pages(found: DataFrame, heading: str) -> DataFrame:
    """The same rows straight from pages (page_id, html), dealt by page once for all that windows over them ask."""
    return pages.table_rows(found, heading).select("page_id", "record", "row", _year(), "values", "is_header").repartition("page_id")


def _named(names: Column, values: Column) -> Column:
    """A map from header names to values; blank names are col_n, and of equal names the last counts."""
    full = F.transform(names, lambda h, i: F.when(h != "", h).otherwise(F.concat(F.lit("col_"), (i + 1).cast("string"))))
    pairs = F.transform(full, lambda h, i: F.struct(h.alias("name"), F.get(values, i).alias("value")))
    later = lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda x: x["name"] == e["name"])
    distinct = F.size(F.array_distinct(full)) == F.size(full)
    return F.when(distinct, F.map_from_entries(pairs)).otherwise(F.map_from_entries(F.filter(pairs, later)))


def tax_details(rows: DataFrame) -> DataFrame:
    """One row for each page and year of detail tables: LISTS (arrays of maps), tax_amount_summary (a map) and three flags.

    rows: those of rows_of.  A row of one cell names the section; a header row names the columns until another one comes, or
    until a row that does not fit them ends it: any labelled row among tax values and installments does, and so do payments.
    """
    order = Window.partitionBy("page_id", "year").orderBy("record", "row")
    so_far, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    values, n = F.col("values"), F.size("values")
    table_order = Window.partitionBy("page_id", "year", "record").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    own_section = F.last(F.when(n == 1, values[0]), ignorenulls=True).over(table_order)
    rows = rows.withColumn("own_section", own_section).where(n > 1)
    rows = rows.withColumn("section", F.coalesce(F.last(F.nullif("own_section", F.lit("")), ignorenulls=True).over(so_far), F.lit("")))
    section = F.col("section")
    paid, valued, amounts, parts = section.startswith(PAYMENTS), section.contains(VALUES), section.startswith(AMOUNTS), section == INSTALLMENTS
    sets = F.col("is_header") & ~paid
    rows = rows.withColumns({"header": F.last(F.when(sets, values), ignorenulls=True).over(so_far), "data": ~F.col("is_header") & ~paid})
    header, data = F.col("header"), F.col("data")
    fits = F.coalesce(F.size(header) == n, F.lit(False))
    category = fits & F.coalesce(header[0] == "Category", F.lit(False))
    ends = paid | (data & valued & ~category) | (data & ~valued & ~amounts & parts)
    rows = rows.withColumn("ends", F.sum(ends.cast("int")).over(so_far)).withColumn("ended", F.coalesce(F.sum(ends.cast("int")).over(before), F.lit(0)))
    alive = F.coalesce(F.col("ended") == F.last(F.when(sets, F.col("ends")), ignorenulls=True).over(so_far), F.lit(False))
    rows = rows.withColumn("alive", alive).where("data")
    label, amount = _label(values[0]), F.element_at(values, -1)
    named = _named(header, values)
    labelled = F.create_map(F.lit("label"), label, F.lit("amount"), amount)
    mapped = F.col("alive") & fits
    by_header = F.create_map(*[F.lit(x) for pair in BY_HEADER.items() for x in pair])
    credit = amounts & label.isin(CREDITS)
    total = F.create_map(*[F.lit(x) for pair in TOTALS.items() for x in pair])
    kind = (
        F.when(valued, F.when(F.col("alive") & category, "tax_value_rows").when(label == SCHOOL_CREDIT, "tax_credit_rows").otherwise("tax_rate_rows"))
        .when(amounts, F.when(label.isin(list(TOTALS)), "total").when(credit, "tax_credit_rows").when(mapped, F.try_element_at(by_header, F.upper(header[0]))))
        .when(parts, "installment_rows")
    )
    body = F.when(F.col("kind").isin("tax_value_rows", *BY_HEADER.values()), named).when(F.col("kind") == "total", F.create_map(F.try_element_at(total, label), amount)).otherwise(labelled)
    due = F.when((F.col("kind") == "installment_rows") & (label == "Total Due"), amount)
    found = rows.withColumn("kind", kind).withColumns({"body": body, "due": due}).select("page_id", "year", "record", "row", "kind", "body", "due")
    of = lambda name: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == name, F.struct("record", "row", F.map_entries("body").alias("body"))))), lambda x: F.map_from_entries(x["body"]))
    at = F.struct("record", "row")
    last = lambda cond, value: F.max_by(value, F.when(cond, at))
    sums = [(v, last(F.map_contains_key("body", v) & (F.col("kind") == "total"), F.try_element_at("body", F.lit(v)))) for v in TOTALS.values()]
    sums.append(("installment_total_due", last(F.col("due").isNotNull(), F.col("due"))))
    grouped = found.groupBy("page_id", "year").agg(*[of(name).alias(name) for name in LISTS], F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in sums]).alias("sums"))
    summary = F.map_from_entries(F.filter("sums", lambda x: x["value"].isNotNull()))
    return _flagged(grouped.select("page_id", "year", *LISTS, summary.alias("tax_amount_summary")))


def _flagged(found: DataFrame) -> DataFrame:
    charged = lambda rows, name: F.exists(rows, lambda r: F.coalesce(~r["Amount"].isin(["", *ZERO]), F.lit(False)) & ~F.coalesce(_label(r[name]).startswith("No "), F.lit(False)))
    return found.select(
        "page_id", "year", *LISTS, "tax_amount_summary", (F.size("tax_credit_rows") > 0).alias("has_tax_credits"), charged(F.col("special_charge_rows"), "Specials").alias("has_special_charges"),
        charged(F.col("other_tax_item_rows"), "Other Tax Items").alias("has_other_tax_items"),
    )


def detail_payments(rows: DataFrame) -> DataFrame:
    """(page_id, record, row, year, source, data): the payments in detail tables, below a row that announces them.

    The first header row after the announcement names the columns of the rows after it; short rows are filled with
    blanks, what is beyond the header is dropped, and without a header columns are col_n.  Rows of blanks go.
    """
    order = Window.partitionBy("page_id", "record").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    values, n = F.col("values"), F.size("values")
    opens = (n == 1) & F.lower(values[0]).startswith(PAYMENTS.lower())
    part = Window.partitionBy("page_id", "record", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("part", F.sum(opens.cast("int")).over(order)).where((F.col("part") > 0) & (n > 1))
    rows = rows.withColumns({"header": F.first(F.when(F.col("is_header"), values), ignorenulls=True).over(part), "at": F.first(F.when(F.col("is_header"), F.col("row")), ignorenulls=True).over(part)})
    rows = rows.where(F.col("at").isNull() | (F.col("row") != F.col("at")))
    width = F.greatest(F.size("header"), n)
    filled = F.concat(values, F.array_repeat(F.lit(""), F.greatest(F.size("header") - n, F.lit(0))))
    blank = F.transform(values, lambda x: F.lit(""))
    data = F.when(F.col("header").isNull(), _named(blank, values)).otherwise(_named(F.slice("header", 1, width), filled))
    return rows.where(F.exists(values, lambda x: x != "")).select("page_id", "record", "row", "year", F.lit("tax_detail_payments").alias("source"), data.alias("data"))


@lru_cache(4096)
def _year_of(section: str) -> int | None:
    said = re.search(r"(?<![0-9])([0-9]{4})(?![0-9])", section)
    return int(said[1]) if said else None


def _names(header: list[str], values: list[str]) -> dict[str, str]:
    """``_named`` for one row: of equal names the last counts, at its place."""
    out: dict[str, str] = {}
    for i, (name, value) in enumerate(zip(header, values, strict=False), 1):
        name = name or f"col_{i}"
        if name in out:
            del out[name]
        out[name] = value
    return out


def _page_details(rows: list[tuple]) -> list[tuple]:
    """``tax_details`` for the rows of one page, in order: (year, a list of maps for each of LISTS, summary)."""
    out = []
    years = {_year_of(section): [] for section in dict.fromkeys(r[2] for r in rows)}
    if len(years) == 1:
        years = dict.fromkeys(years, rows)
    else:
        for r in rows:
            years[_year_of(r[2])].append(r)
    for year, own_rows in years.items():
        lists: dict[str, list[dict]] = {name: [] for name in LISTS}
        sums: dict[str, str] = {}
        section, own, table, header, alive, some = "", None, None, None, False, False
        paid = valued = amounts = parts = False
        for record, _, _, is_header, values in own_rows:
            if record != table:
                table, own = record, None
            if len(values) == 1:
                own = values[0]
                continue
            if own and own != section:
                section = own
                paid, valued, amounts, parts = section.startswith(PAYMENTS), VALUES in section, section.startswith(AMOUNTS), section == INSTALLMENTS
            if paid:
                alive = False
                continue
            if is_header:
                header, alive = values, True
                continue
            some, label, amount = True, values[0].rstrip(":").strip(" "), values[-1]
            mapped = alive and len(header) == len(values)
            if valued:
                if mapped and header[0] == "Category":
                    lists["tax_value_rows"].append(_names(header, values))
                    continue
                lists["tax_credit_rows" if label == SCHOOL_CREDIT else "tax_rate_rows"].append({"label": label, "amount": amount})
                alive = False
            elif amounts:
                if label in TOTALS:
                    sums[TOTALS[label]] = amount
                elif label in CREDITS:
                    lists["tax_credit_rows"].append({"label": label, "amount": amount})
                elif mapped and (name := BY_HEADER.get(header[0].upper())):
                    lists[name].append(_names(header, values))
            elif parts:
                lists["installment_rows"].append({"label": label, "amount": amount})
                alive = False
                if label == "Total Due":
                    sums["installment_total_due"] = amount
        if some:
            out.append((year, *lists.values(), {k: sums[k] for k in (*TOTALS.values(), "installment_total_due") if k in sums}))
    return out


def _page_payments(rows: list[tuple]) -> list[tuple]:
    """``detail_payments`` for the rows of one page, in order: (record, row, year, data)."""
    out, table, header, paid = [], None, None, False
    for record, row, section, is_header, values in rows:
        if record != table:
            table, header, paid = record, None, False
        if len(values) == 1:
            if values[0].lower().startswith(PAYMENTS.lower()):
                header, paid = None, True
        elif paid and is_header and header is None:
            header = values
        elif paid and any(values):
            data = _names([""] * len(values), values) if header is None else _names(header, values + [""] * (len(header) - len(values)))
            out.append((record, row, _year_of(section), data))
    return out


class _Maps:
    """A column of maps in the making, flat, so that no objects for rows pile up."""

    def __init__(self) -> None:
        self.keys, self.items, self.ends = [], [], [0]

    def append(self, row: dict[str, str]) -> None:
        self.keys.extend(row)
        self.items.extend(row.values())
        self.ends.append(len(self.keys))

    def array(self) -> pa.Array:
        return pa.MapArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(self.keys, pa.string()), pa.array(self.items, pa.string()))


class _Lists:
    """A column of lists of maps."""

    def __init__(self) -> None:
        self.maps, self.ends = _Maps(), [0]

    def append(self, rows: list[dict[str, str]]) -> None:
        keys, items, ends = self.maps.keys, self.maps.items, self.maps.ends
        for row in rows:
            keys.extend(row)
            items.extend(row.values())
            ends.append(len(keys))
        self.ends.append(len(ends) - 1)

    def array(self) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), self.maps.array())


_KINDS = {"long": pa.int64(), "int": pa.int32(), _MAP: _Maps, f"array<{_MAP}>": _Lists}


def _by_page(found: DataFrame, heading: str, of_page: Callable[[list[tuple]], list[tuple]], schema: dict[str, str]) -> DataFrame:
    """page_id and the columns of ``schema``, the rows that ``of_page`` makes of the table rows of each page; broken pages give none."""
    wanted, schema = heading.lower(), {"page_id": "long", **schema}

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                columns = [kind() if isinstance(kind := _KINDS[k], type) else [] for k in schema.values()]
                for page, html in zip(batch.column(0)[at : at + 2000].to_pylist(), batch.column(1)[at : at + 2000].to_pylist(), strict=True):
                    try:
                        made = of_page(pages.page_rows(html or "", wanted))
                    except (AssertionError, ValueError, TypeError):
                        continue
                    for row in made:
                        for column, value in zip(columns, (page, *row), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) if isinstance(c, list) else c.array() for c, k in zip(columns, schema.values(), strict=True)], names=list(schema))

    return found.select(F.col("page_id").cast("long"), "html").mapInArrow(read, ", ".join(f"{n} {k}" for n, k in schema.items()))


def tax_details_of_pages(found: DataFrame, heading: str) -> DataFrame:
    """``tax_details`` of pages (page_id, html) with one page_id each; nothing is shuffled."""
    return _flagged(_by_page(found, heading, _page_details, {"year": "int", **dict.fromkeys(LISTS, f"array<{_MAP}>"), "tax_amount_summary": _MAP}))


def detail_payments_of_pages(found: DataFrame, heading: str) -> DataFrame:
    """``detail_payments`` of pages (page_id, html) with one page_id each; nothing is shuffled."""
    rows = _by_page(found, heading, _page_payments, {"record": "int", "row": "int", "year": "int", "data": _MAP})
    return rows.select("page_id", "record", "row", "year", F.lit("tax_detail_payments").alias("source"), "data")


def key_value_records(rows: DataFrame, source: str) -> DataFrame:
    """(page_id, record, year, source, data) of assessment summaries: rows of two plain cells are name and value, the last of a name counts.

    The year is that of the header's second cell, else of the heading.
    """
    values = F.col("values")
    head = rows.where("is_header").groupBy("page_id", "record").agg(F.min_by(F.regexp_extract(F.get(values, F.lit(1)), r"(\d{4})", 1), F.when(F.size("values") > 1, F.col("row"))).alias("said"))
    pairs = rows.where("not is_header and size(values) = 2").select("page_id", "record", "year", "row", values[0].alias("name"), values[1].alias("value")).where("name <> ''")
    last = pairs.groupBy("page_id", "record", "year", "name").agg(F.max_by("value", "row").alias("value"))
    kept = last.groupBy("page_id", "record", "year").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("data"))
    both = kept.join(head, ["page_id", "record"], "left")
    return both.select("page_id", "record", F.coalesce(F.nullif("said", F.lit("")).cast("int"), "year").alias("year"), F.lit(source).alias("source"), "data")


def tax_summaries(rows: DataFrame) -> DataFrame:
    """(page_id, record, year, data) of tax summary tables: rows of three headers are named by them for the next row of three
    plain cells; other rows are a name and their last cell.  Later names win; tables without a name and value go.
    """
    order = Window.partitionBy("page_id", "record").orderBy("row")
    so_far, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    values, three = F.col("values"), F.size("values") == 3
    sets = F.col("is_header") & three
    plain = ~F.col("is_header") & three
    rows = rows.withColumns({"header": F.last(F.when(sets, values), ignorenulls=True).over(so_far), "head_at": F.max(F.when(sets, F.col("row"))).over(so_far), "plain_at": F.max(F.when(plain, F.col("row"))).over(before)})
    first = plain & F.col("header").isNotNull() & (F.coalesce("plain_at", F.lit(-1)) < F.col("head_at"))
    pairs = F.transform("header", lambda h, i: F.struct(h.alias("name"), F.get(values, i).alias("value"), i.alias("at")))
    own = F.when(F.size("values") > 1, F.array(F.struct(_label(values[0]).alias("name"), F.nullif(F.element_at(values, -1), F.lit("")).alias("value"), F.lit(0).alias("at"))))
    entries = F.when(sets, F.lit(None)).when(first, pairs).otherwise(own)
    long = rows.select("page_id", "record", "year", "row", F.inline(entries)).where("name <> '' and value is not null")
    last = long.groupBy("page_id", "record", "year", "name").agg(F.max_by("value", F.struct("row", "at")).alias("value"))
    return last.groupBy("page_id", "record", "year").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("data"))
