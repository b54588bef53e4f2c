from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from lotlens.llm import decontam


def tokens(t):
    return [w.lower() for w in re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", t or "")]


def brute(docs, tests, least=12, share=0.8):
    """All diagonals of all pairs that share a seed hit, by plain loops."""
    found = set()
    for d, dt in docs:
        a = tokens(dt)
        for k, kt in tests:
            b = tokens(kt)
            if not b:
                continue
            seeds = decontam.SEEDS if len(b) >= max(map(len, decontam.SEEDS)) else ("1" * len(b),)
            for diag in range(-len(b) + 1, len(a)):
                same = [0 <= i + diag < len(a) and a[i + diag] == b[i] for i in range(len(b))]
                hit = any(all(same[i + j] for j, m in enumerate(s) if m == "1") and i + diag >= 0 and i + diag + len(s) <= len(a) for s in seeds for i in range(len(b) - len(s) + 1))
                if not hit:
                    continue
                lo, hi = max(0, -diag), min(len(b), len(a) - diag)
                spans = ((s, e) for s in range(lo, hi) for e in range(s + 1, hi + 1))
                best = max((sum(same[s:e]) for s, e in spans if sum(same[s:e]) >= share * (e - s) - 1e-9), default=0)
                if best >= min(least, -(-8 * len(b) // 10)):
                    found.add((d, k))
    return found


def test_substitutions_and_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(120)] + ["the", "of", "and"] * 20
    passage = lambda n: [rng.choice(vocab) for _ in range(n)]
    tests = [(k, " ".join(passage(n))) for k, n in enumerate([30, 16, 22, 8, 5, 40])] + [(90, None), (91, "")]
    docs = []
    for d in range(40):
        body = passage(60)
        if d % 2:
            item = tests[d % 6][1].split()
            for p in rng.sample(range(len(item)), len(item) // 8):
                item[p] = f"sub{p}"
            body[20:20] = [w.upper() + "," for w in item]
        docs.append((d, " ".join(body)))
    df, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.overlaps(df, t).collect()}
    assert got == brute(docs, tests)
    assert len(got) >= 12
    assert {(r["doc_id"], r["item_id"]) for r in decontam.overlaps(df, t, max_test_bytes=60).collect()} == got  # joined by a shuffle
    kept = decontam.drop_contaminated(df, t, max_test_bytes=60)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in got}


def test_all_benchmark_copies_are_found(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda t: f" {' '.join(tokens(t))} "
    items = [(r["item_id"], plain(r["text"])) for r in bench.collect()]
    want = {(r["doc_id"], k) for r in docs.collect() for k, t in items if t in plain(r["text"])}
    assert want == {(r["doc_id"], r["item_id"]) for r in decontam.overlaps(docs, bench).collect()}


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "ban " * 20), (None, "word word word word word word word word word word word word"), (3, None)], "item_id long, text string")
    found = decontam.overlaps(odd, bench)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(13, None)}
    kept = decontam.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontam.overlaps(none, bench).count() == 0 and decontam.drop_contaminated(none, bench).count() == 0
    assert decontam.overlaps(odd, bench.where(F.lit(False))).count() == 0 and decontam.drop_contaminated(odd, bench.where(F.lit(False))).count() == odd.count()


def test_repeated_patterns_and_items(spark, monkeypatch):
    """A pattern that repeats in text and item, with few hits looked at together, and copies of an item under other ids."""
    text = "a b c d e f g h " * 60
    rows = [(1, "x " * 30 + text), (2, "nothing of the kind"), (3, text.upper())]
    tests = [(k, text) for k in range(3)] + [(None, text), (9, "q " * 50)]
    df, t = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"], r["n_match"]) for r in decontam.overlaps(df, t).collect()), key=repr)
    assert got == sorted([(d, k, 480) for d in (1, 3) for k in (0, 1, 2, None)], key=repr)
    index = decontam.TestIndex(["k"], [text])
    tokens = index.items[0]
    want = index.diagonals(tokens)
    monkeypatch.setattr(decontam, "HITS", 50)
    assert index.diagonals(tokens) == want and len(want) == len(set(want)) > 50


def test_both_ways_agree_on_all_columns(spark, odd):
    """Broadcast index and shuffled join give the same rows, with repeated items and rows, short items and nulls."""
    line = "This very line is repeated in many documents, says nobody."
    long = odd.where("doc_id = 11").first().text
    items = [(1, line), (2, line), (3, "short"), (4, None), (5, ""), (6, " ".join(long.split()[50:90])), (7, "word word word"), (8, "nothing of this kind stands in any of the documents that are here at all")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    one, two = (sorted(map(tuple, decontam.overlaps(odd, tests, max_test_bytes=n).collect()), key=repr) for n in (8 << 20, 0))
    assert one == two and len(one) > 10
    more = odd.withColumns({"row": F.lit("own"), "doc": F.lit(1), "key": F.lit("k")})
    a, b = (decontam.drop_contaminated(more, tests, max_test_bytes=n) for n in (8 << 20, 0))
    assert a.columns == b.columns == more.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert decontam.overlaps(odd, tests.where("false"), max_test_bytes=-1).count() == 0 and decontam.drop_contaminated(odd.where("false"), tests, max_test_bytes=0).count() == 0
