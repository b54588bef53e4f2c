"""Pages that are finished where they are read give what windows over their rows give."""

from __future__ import annotations

import random

from lotlens.plans import taxes
from lotlens.sources import pages, tax_pages
from pyspark.sql import functions as F

PIECES = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>", "<h2>", "</h2>", "<h3>Tax Details 2024</h3>", "x", " a &amp;  b ", "&lt", ">", "\n", "<td>1</td>", "<tr><th>a</th><td></td></tr>", "<table><tr><td>1</td></tr></table>"]
SECTIONS = ["Tax Values", "Tax Values for 2024", "Tax Amounts for 2024", "Installment Amounts", "Tax Payments for 2024", "tax payments for 1", "", "other"]
HEADERS = [["Category", "Land"], ["Category", "", "Land", "Land"], ["Jurisdiction", "Amount"], ["specials", "Amount"], ["Specials", "Amount"], ["Other Tax Items", "b", "Amount"], ["Date", "", "Date"]]
LABELS = ["Class", "School Levy Tax Credit:", "LOTTERY CREDIT::", "Total Taxes", "Total Amount Due:", "Total Due: ", "No specials", "", "Sewer :"]


def _page(rng):
    def row():
        kind, label = rng.random(), rng.choice(LABELS)
        if kind < 0.3:
            return f"<tr><td>{rng.choice(SECTIONS)}</td></tr>"
        if kind < 0.55:
            return "<tr>" + "".join(f"<th>{h}</th>" for h in rng.choice(HEADERS)) + "</tr>"
        return f"<tr><td>{label}</td>" + "".join(f"<td>{rng.choice(['$5.00', '0', '', 'a &amp; b'])}</td>" for _ in range(rng.randrange(4))) + "</tr>"

    broken = rng.choice(["", "", "<p>", "<table><tr><td>Tax Values</td></tr>"])
    return broken + "".join(f"<h3>{rng.choice(['Tax Details 2024', 'Tax Details 2023', 'tax details 20245', 'none'])}</h3><table>" + "".join(row() for _ in range(rng.randrange(30))) + "</table>" for _ in range(rng.randrange(4)))


def test_plain_pages_equal_the_parser():
    rng, plain = random.Random(7), 0
    for at in range(6000):
        html = _page(rng) if at % 3 == 0 else "".join(rng.choices(PIECES, k=rng.randrange(25)))
        for heading in ("tax details", ""):
            found = pages._plain_rows(html, heading)
            assert found is None or found == pages._Page().read(html).table_rows(heading), html
        plain += found is not None and len(found) > 3
    assert plain > 500


def test_pages_are_finished_where_they_are_read(spark):
    rng = random.Random(11)
    df = spark.createDataFrame([(i, _page(rng) if i else None) for i in range(600)], "page_id long, html string").cache()
    rows = tax_pages.rows_of(pages.extract(df), "tax details")
    entries = lambda found: found.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map")) else F.col(c) for c, t in found.dtypes])
    for old, new in ((tax_pages.tax_details(rows), tax_pages.tax_details_of_pages(df, "Tax details")), (tax_pages.detail_payments(rows), tax_pages.detail_payments_of_pages(df, "Tax details"))):
        assert new.columns == old.columns and [t for _, t in new.dtypes] == [t for _, t in old.dtypes]
        assert "Exchange" not in new._jdf.queryExecution().executedPlan().toString()
        assert new.count() == old.count() > 300
        assert entries(old).exceptAll(entries(new)).count() == 0


def test_queries_shuffle_no_rows_of_pages(spark):
    """Lines and orders are dealt by order; of what is read from pages only sums of payments are shuffled."""
    details = taxes.tax_detail_pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in details and details.index("MapInArrow") < details.index("Exchange")
    paid = taxes.tax_detail_payments(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in paid
