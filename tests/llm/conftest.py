from __future__ import annotations

import pytest

WORDS = [a + b for a in "ba ke li mo nu ra se ti".split() for b in "ban der fil gom hus kat lin mer".split()]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty, long, repeated and tied values and columns with the names that operators make."""
    line = "This very line is repeated in many documents, says nobody."
    long = " ".join(WORDS[(i * i) % 64] for i in range(30_000))
    texts = [None, "", "   ", "!!! 123", "short", line, f"{line}\nA", f" {line.upper()} \nB", f"{line}\nC\n{line}", f"\t{line}\n", long, long + " tail", long, "word " * 400, "é" * 50, "x\n" * 2000]
    rows = [(i, t, None if i % 4 == 0 else "en", None if i == 3 else f"s{i % 2}", i, -1, 0.5, "k", 7) for i, t in enumerate(texts)]
    rows += [rows[5], (None, line, "de", "s", 1, -1, 0.5, "k", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines int, score double, key string, component long")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
