"""Tax and assessment tables of inline pages."""

from __future__ import annotations

import pytest
from lotlens.sources import pages
from lotlens.sources import tax_pages as X


def table(*rows):
    """Rows as texts of cells: ``*a`` is a header cell."""
    cell = lambda c: f"<th>{c[1:]}</th>" if c.startswith("*") else f"<td>{c}</td>"
    return "<table>" + "".join("<tr>" + "".join(map(cell, r)) + "</tr>" for r in rows) + "</table>"


@pytest.fixture()
def rows(spark):
    def of(html, heading):
        return X.rows_of(pages.extract(spark.createDataFrame([(1, html)], "page_id long, html string")), heading)

    return of


DETAIL = "<h3>Tax Details 2024</h3>" + table(
    ["Tax Values for 2024"], ["*Category", "*Land", "*Total"], ["Class 1", "10", "30"], ["Class 2", "1", "2"], ["School Levy Tax Credit:", "$5.00"], ["Class 3", "9", "9"], ["Mill Rate:", "0.02"],
    ["Tax Amounts for 2024"], ["*Jurisdiction", "*Amount"], ["County", "$7.00"], ["Total Taxes:", "$90.00"], ["LOTTERY CREDIT", "$3.00"], ["City", "$8.00"], ["a", "b", "c"],
    ["*Specials", "*Amount"], ["No specials", "$9.00"], ["*Other Tax Items", "*Amount"], ["Drain", "$0.00"], ["Sewer", "$4.00"], ["Total Amount Due", "$87.00"],
    ["Installment Amounts"], ["First:", "$40.00"], ["Total Due:", "$87.00"], ["*Jurisdiction", "*Amount"],
    ["Tax Payments for 2024"], ["*Date of Payment", "*Amount", "*Receipt"], ["1/2/2024", "$40.00"], ["", "", ""], ["2/2/2024", "$47.00", "r", "beyond"],
)


def test_detail_tables_are_routed_by_section_and_header(rows):
    (r,) = X.tax_details(rows(DETAIL, "tax details")).collect()
    assert (r.page_id, r.year) == (1, 2024)
    assert r.tax_value_rows == [{"Category": "Class 1", "Land": "10", "Total": "30"}, {"Category": "Class 2", "Land": "1", "Total": "2"}]
    assert r.tax_rate_rows == [{"label": "Class 3", "amount": "9"}, {"label": "Mill Rate", "amount": "0.02"}]  # the labelled credit ended the header
    assert r.tax_credit_rows == [{"label": "School Levy Tax Credit", "amount": "$5.00"}, {"label": "LOTTERY CREDIT", "amount": "$3.00"}]
    assert r.tax_jurisdiction_rows == [{"Jurisdiction": "County", "Amount": "$7.00"}, {"Jurisdiction": "City", "Amount": "$8.00"}]
    assert r.special_charge_rows == [{"Specials": "No specials", "Amount": "$9.00"}] and [x["Amount"] for x in r.other_tax_item_rows] == ["$0.00", "$4.00"]
    assert r.installment_rows == [{"label": "First", "amount": "$40.00"}, {"label": "Total Due", "amount": "$87.00"}]
    assert r.tax_amount_summary == {"total_taxes": "$90.00", "total_amount_due": "$87.00", "installment_total_due": "$87.00"}
    assert (r.has_tax_credits, r.has_special_charges, r.has_other_tax_items) == (True, False, True)


def test_payments_of_detail_tables(rows):
    got = X.detail_payments(rows(DETAIL, "tax details")).orderBy("row").collect()
    assert [(r.year, r.source, r.data) for r in got] == [
        (2024, "tax_detail_payments", {"Date of Payment": "1/2/2024", "Amount": "$40.00", "Receipt": ""}), (2024, "tax_detail_payments", {"Date of Payment": "2/2/2024", "Amount": "$47.00", "Receipt": "r"}),
    ]
    bare = "<h3>Tax Details</h3>" + table(["Tax Payments for 2023"], ["x", "y"], ["*A", "*"], ["1", "2"], ["*late", "*header"], ["tax payments for 2022"], ["*B", "*B"], ["3", "4"])
    assert [r.data for r in X.detail_payments(rows(bare, "tax details")).orderBy("row").collect()] == [{"col_1": "x", "col_2": "y"}, {"A": "1", "col_2": "2"}, {"A": "late", "col_2": "header"}, {"B": "4"}]


def test_years_are_apart_and_unknown_years_together(rows):
    html = "".join(f"<h3>Tax Details {y}</h3>" + table(["Installment Amounts"], ["First", a]) for y, a in (("2023", "1"), ("2024", "2"), ("", "3"), ("", "4")))
    assert sorted((r.year or 0, [x["amount"] for x in r.installment_rows]) for r in X.tax_details(rows(html, "tax details")).collect()) == [(0, ["3", "4"]), (2023, ["1"]), (2024, ["2"])]


def test_assessment_summary(rows):
    html = "<h2>Assessment Summary</h2>" + table(["*Assessment", "*2025"], ["Land", "$1"], ["Land", "$2"], ["", "x"], ["*Total", "9"], ["a", "b", "c"]) + "<h2>Other</h2>" + table(["Land", "no"])
    (r,) = X.key_value_records(rows(html, "assessment summary"), "summary").collect()
    assert (r.year, r.source, r.data) == (2025, "summary", {"Land": "$2"})


def test_tax_summary(rows):
    html = "<h2>Tax Summary 2022</h2>" + table(["*Land", "*", "*Total"], ["Net:", "", "5"], ["1", "2", "3"], ["4", "5", "6"], ["Taxes:", "$9"], ["Blank", ""], ["alone"])
    (r,) = X.tax_summaries(rows(html, "tax summary")).collect()
    assert (r.year, r.data) == (2022, {"Land": "Net:", "Total": "5", "1": "3", "4": "6", "Taxes": "$9"})
