from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lotlens.functions import parsing as P
from lotlens.functions import text as T


def values(spark, texts, *exprs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", *[e(F.col("t")).alias(f"c{k}") for k, e in enumerate(exprs)]).orderBy("i").collect()
    return [r["c0"] if len(exprs) == 1 else tuple(r)[1:] for r in rows]


def test_blank_and_null_tokens(spark):
    assert values(spark, [" a \t b ", "", None, " N/A ", "tbd"], T.collapsed, T.without_null_tokens) == [("a b", "a b"), (None, None), (None, None), ("N/A", None), ("tbd", None)]


def test_parcel_and_crosswalk_keys(spark):
    got = values(spark, ["061/0601-234-5678-9", "x/0601 2345 6789", None], T.parcel_key, T.crosswalk_key)
    assert got[0] == ("061060123456789", "061061023456789")
    assert got[1] == ("X060123456789", "X061023456789")
    assert got[2] == (None, None)


@pytest.mark.parametrize(
    "text, want",
    [
        ("123 north main street, madison, wi 53703", "123 N MAIN ST"),
        ("5 Oak Avenue East Madison WI 53703-1234", "5 OAK AVE E"),
        ("5 Oak Ave Apt 2 B Madison, WI 53703", "5 OAK AVE APT 2 B"),
        ("12 Pine Rd Unit5 Town WI 53703", "12 PINE RD UNIT5"),
        ("PO Box 7 Madison WI 53703", "PO BOX 7 MADISON WI 53703"),
        ("12 West Lane", "12 W LN"),
    ],
)
def test_sale_address(spark, text, want):
    assert values(spark, [text], T.sale_address_key) == [want]


def test_legal_keys(spark):
    sale = values(spark, ["Lot TWO (2), Block 3, First Addition to The Oaks; rest", "Block 3A, Lot 4, Elm Park", "Outlot 1"], T.sale_legal_key)
    assert sale == ["SUBDIVISION:OAKS|LOT:2|BLOCK:3", "SUBDIVISION:ELM PARK|LOT:4|BLOCK:3A", None]
    own = values(spark, ["Elm Park BLOCK 3A, LOT 4", "THE OAKS LOT 2", "LOT 5 BLOCK 1 PINE", "nothing"], T.parcel_legal_key)
    assert own == ["SUBDIVISION:ELM PARK|LOT:4|BLOCK:3A", "SUBDIVISION:OAKS|LOT:2", "SUBDIVISION:PINE|LOT:5|BLOCK:1", None]


def test_legal_keys_of_sales(spark):
    texts = {
        "Lot Twenty-three (23), Block Four (4), Sixth Addition to Autumn Grove, in the Village": "SUBDIVISION:AUTUMN GROVE|LOT:23|BLOCK:4",
        "Block Four (4), Lot Twenty-three (23), Sixth Addition to Autumn Grove.": "SUBDIVISION:AUTUMN GROVE|LOT:23|BLOCK:4",
        "That part of Lot 4, Block 4, Edward's Park, in the City": None,
        "lot 7A ,  The  Oak's Edge; rest": "SUBDIVISION:OAK S EDGE|LOT:7A",
        "Lot 1, Block 3": "SUBDIVISION:BLOCK 3|LOT:1",
        "Lot 1, Block B, Elm": "SUBDIVISION:BLOCK B|LOT:1",
        "Lot 2 (2), Elm": None, "Lot A, Elm": None, "Lot 12AB, Elm": None, "Lot 3 Elm": None, "Lots 3, Elm": None, "Lot 3, . Elm": None, "Block 3, Elm": None, "Block 3, Lot 4": None, "": None,
    }
    assert values(spark, list(texts), T.sale_legal_key) == list(texts.values())


def test_legal_keys_of_parcels(spark):
    texts = {
        "AUTUMN GROVE BLOCK 4 LOT 23": "SUBDIVISION:AUTUMN GROVE|LOT:23|BLOCK:4", "EDWARD'S PARK, LOT 4": "SUBDIVISION:EDWARD S PARK|LOT:4", "LOT 5 BLOCK 1 PINE": "SUBDIVISION:PINE|LOT:5|BLOCK:1",
        "LOT 5 PINE HILL": "SUBDIVISION:PINE HILL|LOT:5", "LOT 5 BLOCK 1": "SUBDIVISION:BLOCK 1|LOT:5", "BLOCK 4 LOT 23": "SUBDIVISION:BLOCK 4|LOT:23", "LOT 5": None, "PINE LOT": None, "PINE LOT X": None,
        "LOT 2 LOT 3": "SUBDIVISION:LOT 2|LOT:3", "pine block b lot 3": "SUBDIVISION:PINE BLOCK B|LOT:3", " . ": None,
    }
    assert values(spark, list(texts), T.parcel_legal_key) == list(texts.values())


def test_money(spark):
    got = values(spark, ["$1,234.565", "(1 200)", "1e3", "abc", None], P.money)
    assert got == [Decimal("1234.57"), Decimal("-1200.00"), None, None, None]
    assert values(spark, ["0.125", "N/A", "--"], P.page_money, lambda c: P.page_money(c, half_even=False)) == [(Decimal("0.12"), Decimal("0.13")), (None, None), (None, None)]


def test_dates(spark):
    d = datetime.date
    texts = ["1/2/2024", "01-02-2024", "2024/1/2", "1/2/24", "1/2/70", "1/2/2024 23:59", "1/2/2024 11:59 PM", "1/2/2024 25:00", "2024-01-02T03:04:05Z", "2024-13-01", "1/2-2024", "x", None]
    want = [d(2024, 1, 2)] * 4 + [d(1970, 1, 2)] + [d(2024, 1, 2)] * 2 + [None] + [d(2024, 1, 2)] + [None] * 4
    assert values(spark, texts, P.flexible_date) == want


def test_years(spark):
    texts = ["2024", "24", "tax 2023 (2023)", "2022/2023"]
    assert values(spark, texts, P.year_number, lambda c: P.year_number(c, one_token=True)) == [(2024, 2024), (None, None), (None, 2023), (None, None)]


def test_codes(spark):
    assert values(spark, ["Void", "odd", " "], P.permit_status) == ["cancelled", "unknown", None]
    assert values(spark, ["denied, partial reduction", "Partially granted", "closed"], P.appeal_outcome) == ["denied", "partial_reduction", "unknown"]
    assert values(spark, ["BOR", "open book 2", "circuit court"], P.appeal_level) == ["board_of_review", "open_book", "court"]


def test_clamp_and_amounts(spark):
    held, over = P.clamped(F.col("x"), 6, 4)
    df = spark.createDataFrame([(1.23456,), (150.0,), (None,)], "x double").select(held.alias("h"), over.alias("o"))
    assert [tuple(r) for r in df.collect()] == [(Decimal("1.2346"), False), (Decimal("99.9999"), True), (None, False)]
    m = spark.createDataFrame([({"Total Amount": "$-5"},), ({"Total": "-5"},), ({"amount": None},)], "d map<string,string>")
    assert [r[0] for r in m.select(P.any_negative_amount(F.col("d"))).collect()] == [True, False, False]


def test_evidence_links(spark):
    got = values(spark, ["kind=photo,ref=a,label=x;kind=photo,ref=a,label=x;kind=bad,ref=b;kind=deed,ref="], lambda c: T.evidence_links(c, ["photo", "deed"]))
    assert [tuple(x) for x in got[0]] == [("photo", "a", "x")]


def test_page_flags(spark):
    """Exempt flags, quarters, placeholder rows and three-valued sections."""
    rows = spark.createDataFrame(
        [(1, "X1", None, None, None), (2, None, True, False, "Town of A"), (3, None, True, None, "Town of A"), (4, "G1", None, None, None), (5, None, False, None, "B"), (6, None, None, None, "B")],
        "id int, cls string, empty boolean, tax boolean, owner string",
    )
    flags = rows.select("id", P.exempt_flag(F.col("cls"), F.col("empty"), F.col("tax"), F.col("owner")).alias("x")).orderBy("id").collect()
    assert [r.x for r in flags] == [True, True, False, False, False, None]
    texts = spark.createDataFrame([(1, "pt NE 1/4 se1/4 sec 2", "No tax information available."), (2, "NE 1/4", "Tax Information"), (3, None, "")], "id int, d string, t string")
    got = texts.select("id", P.quarter_quarter(F.col("d")), P.tax_available(F.col("t"), F.lit(False)), P.tax_section_empty(F.col("t")), P.payments_available(F.col("t"), F.lit(0), F.lit(1))).orderBy("id").collect()
    assert [tuple(r)[1:] for r in got] == [("NE of the SE", False, True, False), (None, True, False, False), (None, None, None, False)]
    data = spark.createDataFrame([(1, {"Date of Payment": "", "col_2": " No payments found. "}), (2, {"Date Paid": "1/2/2020", "col_2": "No payments found."}), (3, {}), (4, None)], "id int, m map<string,string>")
    assert [r[1] for r in data.select("id", P.placeholder_payment(F.col("m"))).orderBy("id").collect()] == [True, False, False, False]
