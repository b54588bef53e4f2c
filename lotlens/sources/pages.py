"""Page extraction: one Arrow job turns HTML into long rows; records are then built with DataFrame operations."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotlens.functions import parsing as P
from lotlens.functions.text import collapsed

LONG = "page_id long, kind string, record int, row int, col int, section string, is_header boolean, name string, value string"
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A tag without attributes.  Pages of such tags and texts only need no search for anything else.
_BARE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)>")
#: Tags whose content is no markup.
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "plaintext", "xmp"}
ROWS = "page_id long, record int, row int, section string, is_header boolean, values array<string>"
#: Pages of headings and of tables whose rows and cells are all closed, with nothing inside of headings and cells.
_PLAIN = re.compile(r"(?:[^<]*+(?:<h([1-6])>[^<]*+</h\1>|<table>(?:[^<]*+<tr>(?:[^<]*+(?:<td>[^<]*+</td>|<th>[^<]*+</th>))*+[^<]*+</tr>)*+[^<]*+</table>))*+[^<]*+")
_HEADING_TEXTS, _CELL_TEXTS = re.compile(r"<h[1-6]>([^<]*)<"), re.compile(r"<t[dh]>([^<]*)<")


class _Page(HTMLParser):
    """Rows (kind, record, row, col, section, is_header, name, value) for links, headings, cells and dt/dd pairs."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.section, self.tables, self.row, self.col, self.n = "", [], -1, -1, {"table": -1, "link": -1, "pair": -1, "heading": -1}
        self.open: list[tuple[str, list[str], str]] = []
        self.term = ""
        self.quiet = 0

    def read(self, html: str) -> _Page:
        """The whole page: bare tags one after the other, any other page by the standard parser."""
        parts = _BARE.split(html)
        if 3 * html.count("<") != len(parts) - 1 or not _RAW.isdisjoint(map(str.lower, parts[2::3])):
            self.feed(html)
            HTMLParser.close(self)
            return self
        if parts[0]:
            self.handle_data(unescape(parts[0]))
        for at in range(1, len(parts), 3):
            (self.handle_endtag if parts[at] else self.handle_bare)(parts[at + 1].lower())
            if parts[at + 2] and self.open:
                self.handle_data(unescape(parts[at + 2]))
        return self

    def handle_bare(self, tag: str) -> None:
        self.handle_starttag(tag, [])

    def table_rows(self, heading: str) -> list[tuple]:
        """The rows of tables below headings that contain ``heading``, with the texts of their cells in order."""
        found: dict[tuple[int, int], list] = {}
        for kind, record, row, col, section, is_header, _, value in self.rows:
            if kind == "cell" and heading in section.lower():
                found.setdefault((record, row), []).append((col, value, section, is_header))
        out = []
        for (record, row), cells in found.items():
            first = cells[0][2]
            cells.sort(key=lambda c: c[:2])
            out.append((record, row, first, any(c[3] for c in cells), [c[1] for c in cells]))
        return out

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.quiet += 1
        elif tag == "table":
            self.n["table"] += 1
            self.tables.append((self.n["table"], self.row, self.col))
            self.row = self.col = -1
        elif tag == "tr":
            self.row, self.col = self.row + 1, -1
        elif tag in ("td", "th"):
            self.finish("td", "th")
            self.col += 1
            self.open.append((tag, [], ""))
        elif tag == "a" or tag in _HEADINGS or tag in ("dt", "dd"):
            if tag in ("dt", "dd"):
                self.finish("dt", "dd")
            self.open.append((tag, [], dict(attrs).get("href") or ""))
        elif tag == "br":
            self.handle_data(" ")

    def finish(self, *tags: str) -> None:
        if self.open and self.open[-1][0] in tags:
            self.handle_endtag(self.open[-1][0])

    def handle_data(self, data: str) -> None:
        if not self.quiet:
            for _, parts, _ in self.open:
                parts.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.quiet = max(0, self.quiet - 1)
        if tag in ("tr", "table"):
            self.finish("td", "th")
        if tag == "dl":
            self.finish("dt", "dd")
        if tag == "table" and self.tables:
            _, self.row, self.col = self.tables.pop()
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is None:
            return
        _, parts, href = self.open.pop(at)
        text = " ".join("".join(parts).split())
        if tag in ("td", "th") and self.tables:
            self.rows.append(("cell", self.tables[-1][0], self.row, self.col, self.section, tag == "th", None, text))
        elif tag == "a":
            self.n["link"] += 1
            self.rows.append(("link", self.n["link"], 0, 0, self.section, False, href, text))
        elif tag in _HEADINGS:
            self.n["heading"] += 1
            self.section = text
            self.rows.append(("heading", self.n["heading"], 0, 0, text, False, tag, text))
        elif tag == "dt":
            self.term = text
        elif tag == "dd":
            self.n["pair"] += 1
            self.rows.append(("pair", self.n["pair"], 0, 0, self.section, False, self.term, text))


def _plain_rows(html: str, heading: str) -> list[tuple] | None:
    """The same rows of a page that is headings and flat tables only, by patterns for whole rows; None for any other page."""
    if not _PLAIN.fullmatch(html):
        return None
    clean = "&" not in html and "> " not in html and " <" not in html and " ".join(html.split()) == html
    text = lambda t: t if clean else " ".join(unescape(t).split())
    before, *tables = html.split("<table>")
    texts = _CELL_TEXTS.findall
    out, section, wanted = [], "", not heading
    for record, part in enumerate([before, *tables], -1):
        body, _, after = part.rpartition("</table>")
        if wanted and record >= 0:
            for row, line in enumerate(body.split("<tr>")):
                if cells := texts(line):
                    out.append((record, row - 1, section, "<th>" in line, cells if clean else [text(c) for c in cells]))
        if "<" in after:
            section = text(_HEADING_TEXTS.findall(after)[-1])
            wanted = heading in section.lower()
    return out


def page_rows(html: str, heading: str) -> list[tuple]:
    """(record, row, section, is_header, values) in order of the tables of one page below headings that contain ``heading``, in lower case."""
    found = _plain_rows(html, heading)
    return sorted(_Page().read(html).table_rows(heading)) if found is None else found


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string()]
    names = [x.split()[0] for x in LONG.split(", ")]
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows = []
            for page_id, html in zip(batch.column(0)[at : at + 500].to_pylist(), batch.column(1)[at : at + 500].to_pylist(), strict=True):
                try:
                    rows += [(page_id, *r) for r in _Page().read(html or "").rows]
                except (AssertionError, ValueError, TypeError) as e:  # a broken page is a row, not a failed job
                    rows.append((page_id, "error", 0, 0, 0, None, False, type(e).__name__, str(e)[:500]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 9, kinds, strict=True)], names=names)


def extract(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Long rows of all pages; everything else here starts from them.  Broken pages give a row of kind ``error``."""
    return pages.select(F.col(page_id).cast("long"), html).mapInArrow(_extract, LONG)


def table_rows(pages: DataFrame, heading: str, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, record, row, section, is_header, values): the rows of all tables below a heading that contains ``heading``.

    A page's rows are made where it is read, so that cells need not meet by a shuffle.  Broken pages give none.
    """
    wanted = heading.lower()
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.list_(pa.string())]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                for page, text in zip(batch.column(0)[at : at + 500].to_pylist(), batch.column(1)[at : at + 500].to_pylist(), strict=True):
                    try:
                        rows += [(page, *r) for r in page_rows(text or "", wanted)]
                    except (AssertionError, ValueError, TypeError):
                        continue
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 6, kinds, strict=True)], names=[x.split()[0] for x in ROWS.split(", ")])

    return pages.select(F.col(page_id).cast("long"), html).mapInArrow(read, ROWS)


def key_values(long: DataFrame) -> DataFrame:
    """(page_id, name, value) from two-cell rows and dt/dd; the first of a name on a page wins."""
    cells = long.where("kind = 'cell'").groupBy("page_id", "record", "row").agg(F.max("col").alias("last"), F.min_by("value", "col").alias("name"), F.max_by("value", "col").alias("value"))
    pairs = cells.where("last = 1").select("page_id", F.struct(F.lit(0).alias("k"), "record", "row").alias("at"), "name", "value")
    terms = long.where("kind = 'pair'").select("page_id", F.struct(F.lit(1).alias("k"), "record", "row").alias("at"), "name", "value")
    both = pairs.unionByName(terms).withColumn("name", F.trim(F.regexp_replace("name", ":+$", ""))).where("name <> ''")
    return both.groupBy("page_id", "name").agg(F.min_by("value", "at").alias("value"))


def table_records(long: DataFrame, heading: str | None = None) -> DataFrame:
    """(page_id, record, row, data map) of tables; columns without a fitting header, or of tables without one, are col_n.

    Of columns with one name the last counts.  Rows that are empty throughout go.  With ``heading``: only tables below a heading with this text, up to the next.
    """
    cells = long.where("kind = 'cell'")
    if heading is not None:
        cells = cells.where(F.lower("section").contains(heading.lower()))
    head_at = cells.where("is_header").groupBy("page_id", "record").agg(F.min("row").alias("head"))
    heads = cells.join(head_at, ["page_id", "record"]).where("row = head")
    heads = heads.select("page_id", "record", "head", "col", F.when(F.col("value") != "", F.col("value")).alias("name"))
    widths = heads.groupBy("page_id", "record", "head").agg(F.max("col").alias("head_last"))
    body = cells.join(widths, ["page_id", "record"], "left").where("head is null or row > head")
    fits = F.coalesce(F.max("col").over(Window.partitionBy("page_id", "record", "row")) == F.col("head_last"), F.lit(False))
    named = body.withColumn("fits", fits).join(heads.select("page_id", "record", "col", "name").withColumnRenamed("name", "head_name"), ["page_id", "record", "col"], "left")
    name = F.coalesce(F.when(F.col("fits"), F.col("head_name")), F.concat(F.lit("col_"), F.col("col") + 1))
    last = named.groupBy("page_id", "record", "row", name.alias("name")).agg(F.max_by("value", "col").alias("value"), F.max(F.col("value") != "").alias("some"))
    kept = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value"))))
    rows = last.groupBy("page_id", "record", "row").agg(kept.alias("data"), F.max("some").alias("some"))
    return rows.where("some").drop("some")


def year_columns(records: DataFrame, label: str) -> DataFrame:
    """Detail tables turned: one row for each page, table and year column, with a map from the row labels to its values."""
    long = records.select("page_id", "record", "row", F.col("data")[label].alias("name"), F.explode("data").alias("head", "value"))
    years = long.where(F.col("head").rlike(r"^\d{4}$") & F.col("name").isNotNull())
    last = years.groupBy("page_id", "record", F.col("head").cast("int").alias("year"), "name").agg(F.max_by("value", "row").alias("value"))
    return last.groupBy("page_id", "record", "year").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("data"))


def forward_fill(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Blank values of a column filled from the row above."""
    seen = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(F.nullif(F.trim(name), F.lit("")), ignorenulls=True).over(seen))


def routed_details(rows: DataFrame, keys: list[str], order: list[str], label: str, routes: dict[str, str]) -> DataFrame:
    """Detail rows collected into one array for each section: a row whose label fits a route's pattern opens it."""
    section = F.lit(None).cast("string")
    for name, pattern in reversed(routes.items()):
        section = F.when(F.col(label).rlike(f"(?i){pattern}"), name).otherwise(section)
    opened = rows.withColumn("__open", section)
    seen = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = opened.withColumn("detail", F.last("__open", ignorenulls=True).over(seen)).where(F.col("__open").isNull() & F.col("detail").isNotNull())
    later = lambda a, b: F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).otherwise(0)
    kept = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("at"), "data")), later)
    return inside.groupBy(*keys, "detail").agg(F.transform(kept, lambda x: x["data"]).alias("rows"))


def summary_fields(pairs: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """One row a page with the first alias of each field that is not empty; names compare without case and blanks."""
    plain = F.lower(F.regexp_replace("name", r"\s+", ""))
    rows = pairs.withColumn("__key", plain)
    pick = lambda a: F.max(F.when((F.col("__key") == a.lower().replace(" ", "")) & (F.trim("value") != ""), F.col("value")))
    return rows.groupBy("page_id").agg(*[F.coalesce(*[pick(a) for a in al]).alias(f) for f, al in fields.items()])


def links(long: DataFrame) -> DataFrame:
    """(page_id, position, href, text) of all links that have an address."""
    return long.where("kind = 'link' and name <> ''").select("page_id", F.col("record").alias("position"), F.col("name").alias("href"), F.col("value").alias("text"))


def parcel_links(found: DataFrame, most: int | None = None) -> DataFrame:
    """Distinct parcel numbers of a page in order: a formatted number in the text, else the digits of the path; and whether cut."""
    number = F.coalesce(F.nullif(F.regexp_extract("text", r"(\d{3}/\d{4}-\d{3}-\d{4}-\d)", 1), F.lit("")), F.nullif(F.regexp_extract("href", r"/(\d+)", 1), F.lit("")))
    first = found.withColumn("number", number).where("number is not null").groupBy("page_id", "number").agg(F.min("position").alias("position"))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("page_id").orderBy("position")))
    total = F.count("*").over(Window.partitionBy("page_id"))
    out = ranked.withColumn("truncated", F.lit(False) if most is None else total > most)
    return out if most is None else out.where(F.col("rank") <= most)


def lineage_links(found: DataFrame, kind: Column) -> DataFrame:
    """(page_id, related, kind): related id from the address (10 to 14 digits) or a digit text; the last of a pair wins."""
    related = F.coalesce(F.nullif(F.regexp_extract("href", r"/(\d{10,14})", 1), F.lit("")), F.nullif(F.regexp_extract("text", r"^\D*(\d{10,14})\D*$", 1), F.lit("")))
    rows = found.withColumn("related", related).withColumn("kind", kind).where("related is not null")
    return rows.groupBy("page_id", "related").agg(F.max_by("kind", "position").alias("kind"))


def errors(long: DataFrame) -> DataFrame:
    return long.where("kind = 'error'").select("page_id", F.col("name").alias("error"), F.col("value").alias("message"))


#: Link texts and parts of addresses that name a map.  A county's own map is an argument.
MAP_LINKS = {"has_google_map_link": ("Google Map", ("maps.google.com", "google.com/maps")), "has_bing_map_link": ("Bing Map", ("bing.com/maps",))}


def map_links(found: DataFrame, county: tuple[str, tuple[str, ...]]) -> DataFrame:
    """For each page with links: true for each map that one of them names, else null.  county: link text and address parts."""
    def hit(text: str, parts: tuple[str, ...]) -> Column:
        named = F.col("text") == text
        for part in parts:
            named = named | F.lower("href").contains(part)
        return F.when(F.count_if(named) > 0, True)

    return found.groupBy("page_id").agg(*[hit(*v).alias(k) for k, v in {"has_county_map_link": county, **MAP_LINKS}.items()])


def characteristics(rows: DataFrame, maps: DataFrame) -> DataFrame:
    """One row for each page with what is known of its parcel; pages of which nothing is known are left out.

    rows: page_id, page_text, number, municipality, township_range, section, quarter, description, owner, year, class_code,
    acres, ratio, fair_value, n_tax, n_paid, n_placeholder, n_jurisdictions (null: no table), n_values (filled rows of the
    value table; null: no table).  Fields of the page come before what the formatted number says.  ``complete`` counts the known ones.
    """
    text, parts, place = F.coalesce("page_text", F.lit("")), P.parcel_parts(F.col("number")), P.township_range(F.col("township_range"))
    clean = lambda c: F.nullif(collapsed(F.col(c)), F.lit(""))
    tax, empty = P.tax_available(text, F.coalesce("n_tax", F.lit(0)) > 0), F.col("n_values") == 0
    fields = {
        "formatted_parcel_number": clean("number"), "state_municipality_code": F.coalesce(clean("municipality"), parts["municipality"]),
        "township": F.coalesce(place["township"], parts["township"]), "range": F.coalesce(place["range"], parts["range"]),
        "section": F.coalesce(clean("section"), parts["section"]), "quarter_quarter": F.coalesce(clean("quarter"), P.quarter_quarter(F.col("description"))),
        **{k: F.col(k) for k in ("has_county_map_link", *MAP_LINKS)}, "current_assessment_year": F.col("year"), "current_valuation_classification": clean("class_code"),
        "current_assessment_acres": F.col("acres"), "current_assessment_ratio": F.col("ratio"), "current_estimated_fair_market_value": F.col("fair_value"),
        "current_tax_info_available": tax, "current_payment_history_available": P.payments_available(text, F.col("n_paid"), F.col("n_placeholder")),
        "tax_jurisdiction_count": F.col("n_jurisdictions"), "is_exempt_style_page": P.exempt_flag(clean("class_code"), empty, tax, clean("owner")),
        "has_empty_valuation_breakout": empty, "has_empty_tax_section": P.tax_section_empty(text),
    }
    out = rows.join(maps, "page_id", "left").select("page_id", *[c.alias(n) for n, c in fields.items()])
    return out.withColumn("complete", P.filled(*[F.col(n) for n in fields])).where("complete > 0")
