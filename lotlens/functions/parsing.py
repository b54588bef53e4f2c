"""Parsing of money, dates, years and codes, and small numeric rules, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotlens.functions.text import canonical_text, collapsed

# Codes and words of the data's own conventions.
PERMIT_STATUS = {
    "applied": "applied", "application received": "applied", "issued": "issued", "approved": "issued", "final": "finaled", "finaled": "finaled",
    "closed": "finaled", "completed": "finaled", "expired": "expired", "cancelled": "cancelled", "canceled": "cancelled", "void": "cancelled",
}
STRICT_DATES = ["M/d/yyyy", "M-d-yyyy", "yyyy-M-d"]
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def money(c: Column, parentheses: bool = True) -> Column:
    """decimal(14,2), half up, from text with $ and commas; null if it is no plain number.

    ``parentheses`` is the permit and appeal rule: (1 200) is -1200 and blanks inside go.  Sales keep neither.
    """
    text = F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), "[$,]", "")
    if parentheses:
        text = F.when(text.rlike(r"^\(.*\)$"), F.concat(F.lit("-"), F.regexp_replace(text, r"^\(|\)$", ""))).otherwise(text)
        text = F.regexp_replace(text, " ", "")
    return F.when(text.rlike(_NUMBER), F.round(text.try_cast("decimal(30,10)"), 2).try_cast("decimal(14,2)"))


def page_money(c: Column, half_even: bool = True) -> Column:
    """Money printed on pages; N/A, NA, - and -- are null.  Facts round half to even, characteristics half up."""
    text = F.regexp_replace(collapsed(c), "[$,]", "")
    wide = F.when(text.rlike(_NUMBER), text.try_cast("decimal(30,10)"))
    return (F.bround(wide, 2) if half_even else F.round(wide, 2)).try_cast("decimal(14,2)")


def flexible_date(c: Column) -> Column:
    """The first of six date forms, seven date-time forms and ISO that fits; two-digit years 69-99 are 19xx.

    The form is told by a pattern first, so that each text is parsed once at most.
    """
    text = F.regexp_replace(c, r"^\s+|\s+$", "")
    token = F.translate(F.substring_index(text, " ", 1), "-", "/")
    clock = r"(?: ([01]?\d|2[0-3]):[0-5]?\d(:[0-5]?\d)?)?"
    month_first = text.rlike(rf"^\d{{1,2}}([/-])\d{{1,2}}\1\d{{4}}{clock}$") | text.rlike(r"(?i)^\d{1,2}/\d{1,2}/\d{4} (0?[1-9]|1[0-2]):[0-5]?\d [AP]M$")
    year_first = text.rlike(r"^\d{4}([/-])\d{1,2}\1\d{1,2}$") | text.rlike(rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}{clock}$")
    short_year = text.rlike(r"^\d{1,2}([/-])\d{1,2}\1\d{2}$")
    day = lambda form: F.to_date(F.try_to_timestamp(token, F.lit(form)))
    short = day("M/d/yy")
    iso = F.when(text.try_cast("timestamp").isNotNull(), F.substring(text, 1, 10).try_cast("date"))
    return (
        F.when(month_first, day("M/d/yyyy")).when(year_first, day("yyyy/M/d"))
        .when(short_year, F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short)).when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), iso)
    )


def strict_date(c: Column) -> Column:
    """The three forms that sale files use."""
    text = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in STRICT_DATES])


def year_number(c: Column, one_token: bool = False) -> Column:
    """An integer from 1000 to 9999; with ``one_token`` also the only distinct four-digit number in a text."""
    text = F.regexp_replace(c, r"^\s+|\s+$", "")
    plain = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))
    if one_token:
        found = F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit(r"(?<!\d)(\d{4})(?!\d)")), lambda y: y >= "1000"))
        plain = F.when(text.rlike(r"^[+-]?\d+$"), plain).when(F.size(found) == 1, found[0].try_cast("int"))
    return F.when(plain.between(1000, 9999), plain)


def derived_year(explicit: Column, *dates: Column) -> tuple[Column, Column]:
    """(year, mismatch): the explicit year, else that of the first date; mismatch if both are there and differ."""
    other = F.year(F.coalesce(*dates))
    return F.coalesce(explicit, other), F.coalesce(explicit != other, F.lit(False))


def permit_status(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in PERMIT_STATUS.items() for x in pair])
    token = canonical_text(c)
    return F.when(token.isNotNull(), F.coalesce(F.try_element_at(known, token), F.lit("unknown")))


def _first_match(text: Column, rules: list[tuple[str, list[str], list[str]]]) -> Column:
    out = F.when(text.isNotNull(), F.lit("unknown"))
    for name, equal, part in reversed(rules):
        hit = text.isin(equal) if equal else F.lit(False)
        for p in part:
            hit = hit | text.contains(p)
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def appeal_outcome(c: Column) -> Column:
    """Ordered rules; a denial is tested before a partial reduction."""
    return _first_match(F.lower(collapsed(c)), [
        ("reduction_granted", ["granted", "approved"], ["reduction granted"]),
        ("denied", ["denied", "upheld"], ["denied", "denial", "no change"]),
        ("partial_reduction", ["partial"], ["partial reduction", "partially granted", "modified"]),
        ("withdrawn", ["withdraw", "withdrawn"], []),
        ("dismissed", [], ["dismissed"]),
        ("pending", ["pending", "continued", "open"], []),
    ])


def appeal_level(c: Column) -> Column:
    return _first_match(F.lower(collapsed(c)), [
        ("open_book", [], ["open book"]),
        ("board_of_review", ["bor"], ["board of review"]),
        ("assessor_review", [], ["assessor review", "informal review"]),
        ("court", [], ["tax appeals commission", "court"]),
    ])


def appeal_reason(c: Column) -> Column:
    return _first_match(F.lower(collapsed(c)), [
        ("valuation", [], ["value", "valuat"]),
        ("classification", [], ["class"]),
        ("exemption", [], ["exempt"]),
        ("clerical_error", [], ["clerical", "error"]),
    ])


def value_change(decided: Column, before: Column, outcome: Column) -> tuple[Column, Column]:
    """(decided - before, warning): warning if the value rose although the outcome is a reduction."""
    change = decided - before
    return change, F.coalesce((change > 0) & outcome.isin("reduction_granted", "partial_reduction"), F.lit(False))


def filled(*cols: Column) -> Column:
    """How many of the values are there."""
    return sum((c.isNotNull().cast("int") for c in cols), F.lit(0))


def any_negative_amount(data: Column) -> Column:
    """Whether a map of texts has a key with 'amount' whose number is below zero."""
    def negative(k: Column, v: Column) -> Column:
        return F.lower(k).contains("amount") & F.coalesce(F.regexp_replace(v, r"[^0-9.\-]", "").try_cast("double") < 0, F.lit(False))

    return F.coalesce(F.exists(F.map_entries(data), lambda e: negative(e["key"], e["value"])), F.lit(False))


def clamped(c: Column, precision: int, scale: int) -> tuple[Column, Column]:
    """(value rounded half up and held within decimal(precision, scale), whether it had to be held)."""
    top = F.expr(f"cast({'9' * (precision - scale)}.{'9' * scale} as decimal({precision},{scale}))")
    wide = F.round(c.cast("decimal(38,10)"), scale)
    over = F.coalesce(F.abs(wide) > top, F.lit(False))
    return F.when(wide > top, top).when(wide < -top, -top).otherwise(wide.try_cast(f"decimal({precision},{scale})")), over


def confidence_tier(c: Column, high: float = 0.95, medium: float = 0.85) -> Column:
    return F.when(c.isNull(), "unknown").when(c >= high, "high").when(c >= medium, "medium").otherwise("low")


def price_gap_flag(price: Column, assessed: Column, high: float = 1.5, low: float = 0.5) -> Column:
    """Whether price / assessed is at least ``high`` or at most ``low``; false unless both are known and assessed is positive."""
    ratio = price.cast("double") / assessed.cast("double")
    return F.coalesce(F.when(assessed > 0, (ratio >= high) | (ratio <= low)), F.lit(False))


def parcel_parts(c: Column) -> Column:
    """struct(municipality, township, range, section, quarter, rest) of a parcel number mmm/ttrr-sss-qqqq-r."""
    pattern = r"^(\d{3})/(\d{2})(\d{2})-(\d{2})(\d)-(\d{4})-(\d)$"
    names = ["municipality", "township", "range", "section", "quarter", "parcel", "check"]
    text = collapsed(c)
    return F.when(text.rlike(pattern), F.struct(*[F.regexp_extract(text, pattern, i + 1).alias(n) for i, n in enumerate(names)]))


def township_range(c: Column) -> Column:
    """struct(township, range) with two digits each from texts such as ``T7N R9E``."""
    pattern = r"(?i)T\.?\s*(\d{1,2})\s*([NS])?\W*R\.?\s*(\d{1,2})\s*([EW])?"
    two = lambda i: F.lpad(F.regexp_extract(c, pattern, i), 2, "0")
    return F.when(c.rlike(pattern), F.struct(two(1).alias("township"), two(3).alias("range")))


def quarter_quarter(description: Column) -> Column:
    """``NE of the SW`` from a description such as ``NE 1/4 SW1/4 of section 3``; null without such a pair."""
    pattern = r"\b([NS][EW])\s*1/4\s*([NS][EW])\s*1/4\b"
    text = F.upper(description)
    return F.when(text.rlike(pattern), F.concat(F.regexp_extract(text, pattern, 1), F.lit(" of the "), F.regexp_extract(text, pattern, 2)))


#: Texts of pages, and words of public owners.
NO_TAX, TAX_TITLE = "No tax information available.", "Tax Information"
NO_PAYMENTS, NO_PAYMENT_ROW = "No historic payments found.", "No payments found."
PAYMENT_DATE_FIELDS = ["Date of Payment", "Date Paid", "col_2"]
PUBLIC_OWNERS = ["VILLAGE OF", "CITY OF", "TOWN OF", "COUNTY OF", "STATE OF", "SCHOOL DISTRICT", "SCHOOL DIST", "WI DOT"]


def placeholder_payment(data: Column) -> Column:
    """Whether a payment row (map of texts) only says that there are none; its first date field that is not empty decides."""
    date = F.coalesce(*[F.nullif(data[k], F.lit("")) for k in PAYMENT_DATE_FIELDS])
    return F.coalesce(F.trim(date) == NO_PAYMENT_ROW, F.lit(False))


def tax_available(page_text: Column, has_rows: Column) -> Column:
    """Three-valued: false if the page says that there is none, true with rows or the section's title, else null."""
    return F.when(page_text.contains(NO_TAX), False).when(has_rows | page_text.contains(TAX_TITLE), True)


def tax_section_empty(page_text: Column) -> Column:
    return F.when(page_text.contains(NO_TAX), True).when(page_text.contains(TAX_TITLE), False)


def payments_available(page_text: Column, real: Column, placeholders: Column) -> Column:
    """Three-valued, from the page's text and the numbers of real and placeholder rows (those of detail pages not counted)."""
    return F.when(page_text.contains(NO_PAYMENTS), False).when(real > 0, True).when(placeholders > 0, False)


def exempt_flag(class_code: Column, empty_breakout: Column, tax: Column, owner: Column, public: list[str] | None = None) -> Column:
    """Three-valued: true for an X class, or for an empty value table without tax information under a public owner.

    Else false if the class is known, or owner and value table are; else null.
    """
    words = F.array(*[F.lit(w) for w in public or PUBLIC_OWNERS])
    is_public = F.coalesce(F.exists(words, lambda w: F.upper(owner).contains(w)), F.lit(False))
    no_sections = F.coalesce(empty_breakout & ~tax, F.lit(False))
    return (
        F.when(F.upper(class_code).startswith("X"), True).when(no_sections & is_public, True)
        .when(class_code.isNotNull() | (owner.isNotNull() & empty_breakout.isNotNull()), False)
    )
