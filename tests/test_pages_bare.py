"""Pages of bare tags are read without the standard parser, and give what it gives."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest
from lotlens.sources import pages, tax_pages

PIECES = ["<table>", "</table>", "<tr>", "</TR>", "<td>", "</td>", "<TH>", "</th>", "<h2>", "</h2>", "<dl>", "<dt>", "</dt>", "<dd>", "</dd>", "</dl>", "<a>", "</a>", "<br>", "x", " a &amp; b ", "&lt", "&#65;", ">", "&", "é\n", "1"]


@pytest.mark.parametrize("more", [[], ["<a href='/1'>", "<!-- c -->", "<", "<br/>", "<script>", "</script>", "</ td>"]])
def test_bare_pages_equal_the_standard_parser(more, monkeypatch):
    rng = random.Random(3)
    seen = []
    monkeypatch.setattr(pages._Page, "handle_bare", lambda self, tag: (seen.append(tag), self.handle_starttag(tag, [])))
    for _ in range(4000):
        html = "".join(rng.choices(PIECES + more, k=rng.randrange(30)))
        page = pages._Page()
        page.feed(html)
        HTMLParser.close(page)
        assert pages._Page().read(html).rows == page.rows, html
    assert seen


def test_rows_of_pages_are_those_of_the_long_rows(spark):
    rng = random.Random(5)
    tables = lambda: "".join(rng.choices(["<h3>Tax Details 2024</h3>", "<h3>other</h3>", "<table>", "</table>", "<tr>", "</tr>", "<td>a</td>", "<th>b</th>", "<td></td>"], k=40))
    df = spark.createDataFrame([(i, tables() if i else None) for i in range(200)], "page_id long, html string").repartition(4, "page_id")
    old = tax_pages.rows_of(pages.extract(df), "tax details")
    new = tax_pages.rows_of_pages(df, "Tax details")
    assert new.columns == old.columns and new.count() == old.count() > 0
    assert old.exceptAll(new).count() == 0
    for found in (tax_pages.detail_payments(new), tax_pages.tax_details(new)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and plan.count("MapInArrow") == 1, plan  # one of them is the test's own
