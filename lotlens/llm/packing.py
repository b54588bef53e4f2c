"""Packing into optimal length buckets.

A dynamic programme over the global histogram of lengths chooses the bucket boundaries that waste the fewest padding
tokens; inside each bucket, sequences are dealt into batches of a fixed token budget.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotlens.llm.spans import SPACED, runs, slices, tidy
from lotlens.runtime import cut

#: Sequences numbered by one task at once, about.
GROUP = 4096


def best_bounds(counts: np.ndarray, buckets: int) -> list[int]:
    """Boundaries b1 < .. < bk <= len(counts) - 1, k <= buckets, with the least total padding.

    counts[n] sequences have n tokens and are padded to the first boundary that is not smaller; the last boundary is
    the longest length there is.  Length 0 is padded to a boundary of at least 1.  No sequences: [].
    """
    used = np.flatnonzero(counts)
    if not len(used):
        return []
    sizes = np.maximum(used, 1)
    n, weight = np.cumsum(counts[used]), np.cumsum(counts[used] * used)
    before_n, before_w = np.concatenate([[0], n]).astype(np.float64), np.concatenate([[0], weight]).astype(np.float64)
    m = len(used)
    cost = np.full(m + 1, np.inf)  # of the first j lengths with the boundaries so far
    cost[0] = 0
    back = []
    for _ in range(min(buckets, m)):
        new, choice = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            total = cost[:j] + sizes[j - 1] * (before_n[j] - before_n[:j]) - (before_w[j] - before_w[:j])
            choice[j] = int(np.argmin(total))
            new[j] = total[choice[j]]
        new[0] = 0
        back.append(choice)
        cost = new
    bounds, j = [], m
    for choice in reversed(back):
        if j:
            bounds.append(int(sizes[j - 1]))
            j = int(choice[j])
    return sorted(set(bounds))


def _cut(batches: Iterable[pa.RecordBatch], max_tokens: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, piece, n_tokens, text); the pieces of a text join to the whole text."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for a, b, data, offsets in slices(batch.column("text")):
            start, _, first = runs(data, offsets, SPACED)
            raw, doc, piece, n, texts = data.tobytes(), [], [], [], []
            for i in range(b - a):
                lo, hi = int(first[i]), int(first[i + 1])
                cuts = [int(offsets[i]), *start[lo + max_tokens : hi : max_tokens].tolist(), int(offsets[i + 1])]
                for k in range(len(cuts) - 1):
                    doc.append(ids[a + i])
                    piece.append(k)
                    n.append(min(max_tokens, hi - lo - k * max_tokens))
                    texts.append(raw[cuts[k] : cuts[k + 1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(n, pa.int32()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "piece", "n_tokens", "text"],
            )
        tidy()


def sequences(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_tokens: int = 2048) -> DataFrame:
    """(doc_id, piece, n_tokens, text): texts cut after every ``max_tokens`` tokens; a token is a word with the space after it."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(lambda it: _cut(it, max_tokens), "doc_id long, piece int, n_tokens int, text string")


def pack(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_tokens: int = 2048, buckets: int = 8, budget: int = 65_536, with_text: bool = True
) -> DataFrame:
    """One row for each sequence: doc_id, piece, n_tokens, bucket, bucket_tokens, batch, slot, padding, and its text.

    A text is cut after every ``max_tokens`` tokens and no piece is lost; null and empty texts are one sequence of no
    tokens.  Lengths are at most ``max_tokens``, so the histogram that the driver reads has that many rows.  A batch of
    a bucket holds budget // bucket_tokens sequences (at least one); only a bucket's last batch can be smaller.  Batch
    and slot follow from hashes of id, piece and text: equal rows are interchangeable, and a table's layout does not
    matter.  Repeated rows are sequences of their own; an empty table gives no rows; other columns are not read.

    Numbers within a bucket come from groups of some thousand sequences and their running totals, so that a bucket
    that holds most rows is not numbered by one task.
    """
    pieces = sequences(docs, text, doc_id, max_tokens)
    if not with_text:
        pieces = pieces.withColumn("text", F.xxhash64("text"))
    histogram = pieces.groupBy("n_tokens").count().collect()  # max_tokens + 1 rows at most
    counts = np.zeros(max_tokens + 1, np.int64)
    for r in histogram:
        counts[r["n_tokens"]] = r["count"]
    bounds = best_bounds(counts, buckets)
    groups = max(1, int(counts.sum()) // GROUP)

    bucket = F.lit(len(bounds) - 1)
    size = F.lit(bounds[-1] if bounds else 1)
    for k in reversed(range(len(bounds) - 1)):
        here = F.col("n_tokens") <= bounds[k]
        bucket, size = F.when(here, k).otherwise(bucket), F.when(here, bounds[k]).otherwise(size)
    order = F.xxhash64("doc_id", "piece", "text")
    rows = pieces.select("*", bucket.cast("int").alias("bucket"), size.cast("int").alias("bucket_tokens"), order.alias("__order"))
    rows = rows.withColumn("__group", F.pmod(F.shiftrightunsigned("__order", 20), F.lit(groups)))
    if not with_text:
        rows = rows.drop("text")
    tied = Window.partitionBy("bucket", "__group").orderBy("__order", "doc_id", "piece")
    rows = rows.withColumn("__n", F.row_number().over(tied))
    sizes = cut(rows.groupBy("bucket", "__group").agg(F.count("*").alias("__size")))
    total = F.sum("__size").over(Window.partitionBy("bucket").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select("bucket", "__group", F.coalesce(total, F.lit(0)).alias("__before"))
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_tokens")))
    at = F.col("__before") + F.col("__n") - 1
    out = rows.join(before, ["bucket", "__group"]).withColumns(
        {"batch": F.floor(at / per_batch), "slot": F.pmod(at, per_batch).cast("int"), "padding": F.col("bucket_tokens") - F.col("n_tokens")}
    )
    names = ["doc_id", "piece", "n_tokens", "bucket", "bucket_tokens", "batch", "slot", "padding"]
    return out.select(*names, *["text"] * with_text)
