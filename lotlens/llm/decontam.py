"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over consecutive tokens; only the positions it selects are hashed, so a test passage is still
found when tokens at the ignored positions were replaced.  Hashes of the test items are joined with the hashes at every
token position of every training document, and each hit is verified along its diagonal, where substitutions cost but
do not end an overlap.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotlens.llm.spans import WORDS, mix, runs, slices, tidy, token_hashes
from lotlens.runtime import cut

#: Fixed masks of weight 6; 1: the token is hashed, 0: it may differ.
SEEDS = ("1101001011", "1110010101", "1011100101", "111111")
#: Bytes of distinct test texts up to which their index goes to every executor; beyond, hashes are joined by a shuffle.
MAX_TEST_BYTES = 8 << 20
#: Bits of the table that then refuses most hashes of documents before the shuffle (16 MB), whatever the size of the tests.
TABLE_BITS = 27
#: Hits of a seed that are looked at together; a pattern that repeats in text and item has very many.
HITS = 1 << 18
ROWS = "doc_id long, key string, n_match long, n_aligned long, doc_token long, item_token long, item_tokens long"


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """A hash of the selected tokens at each start where the mask fits."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[i : i + n]
    return mix(out + np.uint64(len(mask)))


class TestIndex:
    """Seed hashes of test items in sorted arrays, behind a bit table that refuses most other hashes."""

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str], seeds: tuple[str, ...] = SEEDS):
        self.seeds, self.ids, self.items = list(seeds), ids, []
        found: dict[str, list] = {m: [] for m in seeds}
        for data_from, data_to, data, offsets in slices(pa.array(texts, pa.string())):
            start, end, first = runs(data, offsets, WORDS)
            tokens = token_hashes(data, start, end)
            self.items += [tokens[first[i] : first[i + 1]] for i in range(data_to - data_from)]
        longest = max(map(len, seeds))
        for k, tokens in enumerate(self.items):
            own = seeds if len(tokens) >= longest else ("1" * len(tokens),) if len(tokens) else ()  # a short item is matched whole
            for m in own:
                h = seed_hashes(tokens, m)
                found.setdefault(m, []).append((h, np.full(len(h), k, np.int32), np.arange(len(h), dtype=np.int32)))
        self.tables = {}
        for m, parts in found.items():
            if parts:
                h, item, at = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.argsort(h, kind="stable")
                bits = max(16, int(len(h)).bit_length() + 3)
                some = np.zeros(1 << bits, bool)
                some[(h >> np.uint64(64 - bits)).astype(np.int64)] = True
                self.tables[m] = (h[order], item[order], at[order], some, np.uint64(64 - bits))

    def diagonals(self, tokens: np.ndarray) -> list[tuple[int, int]]:
        """The distinct (item, token of the text at which the item would start) of all hits, sorted."""
        out = [np.empty(0, np.int64)]
        for m, (keys, item, at, some, shift) in self.tables.items():
            h = seed_hashes(tokens, m)
            where = np.flatnonzero(some[(h >> shift).astype(np.int64)])
            if not len(where):
                continue
            a, b = np.searchsorted(keys, h[where], "left"), np.searchsorted(keys, h[where], "right")
            where, a, n = where[b > a], a[b > a], (b - a)[b > a]
            ends = np.cumsum(n)
            i = 0
            while i < len(n):
                j = max(i + 1, int(np.searchsorted(ends, ends[i] - n[i] + HITS, "right")))
                m = n[i:j]
                row = np.repeat(a[i:j], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                out.append(np.unique((item[row].astype(np.int64) << 32) + (np.repeat(where[i:j], m) - at[row] + (1 << 31))))
                i = j
        both = np.unique(np.concatenate(out))
        return list(zip((both >> 32).tolist(), ((both & 0xFFFFFFFF) - (1 << 31)).tolist(), strict=True))

    def overlap(self, tokens: np.ndarray, k: int, diagonal: int, share: float) -> tuple[int, int, int]:
        """(matches, length, first token of the text) of the stretch along a diagonal with most matches.

        A stretch has at least ``share`` equal tokens, so substitutions may stand anywhere in it.
        """
        item = self.items[k]
        a, b = max(0, diagonal), min(len(tokens), diagonal + len(item))
        same = tokens[a:b] == item[a - diagonal : b - diagonal]
        count = np.concatenate([[0], np.cumsum(same)])
        # count[j] - count[i] >= share * (j - i) is excess[j] >= excess[i]; the first such i comes from the running minimum.
        excess = np.round(count - share * np.arange(len(count)), 9)
        start = np.searchsorted(-np.minimum.accumulate(excess), -excess, "left")
        matches, length = count - count[start], np.arange(len(count)) - start
        end = int(np.lexsort((length, -matches))[0])
        return int(matches[end]), int(length[end]), a + int(start[end])

    def found(self, tokens: np.ndarray, least: int, share: float) -> Iterator[tuple[int, int, int, int, int]]:
        """(item, matches, length, token of the text, token of the item) for each item that the text overlaps."""
        best: dict[int, tuple] = {}
        for k, diagonal in self.diagonals(tokens):
            matches, length, at = self.overlap(tokens, k, diagonal, share)
            need = min(least, int(np.ceil(share * len(self.items[k]))))
            if matches >= need and (k not in best or matches > best[k][0]):
                best[k] = (matches, length, at, at - diagonal)
        for k, x in best.items():
            yield (k, *x)


_held: dict[str, TestIndex] = {}


def _opened(token: str, sent: tuple[list[str], list[str]], seeds: tuple[str, ...]) -> TestIndex:
    """The index, built once in a worker and kept for its next tasks."""
    if token not in _held:
        while len(_held) > 1:
            _held.pop(next(iter(_held)))
        _held[token] = TestIndex(*sent, seeds)
    return _held[token]


def _scan(batches: Iterable[pa.RecordBatch], index: TestIndex, least: int, share: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        rows = []
        for row, end_row, data, offsets in slices(batch.column("text")):
            start, end, first = runs(data, offsets, WORDS)
            tokens = token_hashes(data, start, end)
            for i in range(end_row - row):
                own = tokens[first[i] : first[i + 1]]
                rows += [(doc_ids[row + i], index.ids[k], *x, len(index.items[k])) for k, *x in index.found(own, least, share)]
        cols = list(zip(*rows, strict=True)) or [[]] * 7
        names = [x.split()[0] for x in ROWS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "key" else pa.int64()) for k, c in zip(names, cols, strict=True)], names=names)
        tidy()


def _distinct(tests: DataFrame) -> DataFrame:
    """(key, text): each test text once, however often it is there."""
    return cut(tests.select("key", "text").dropDuplicates(["key"]))


def _masks(seeds: tuple[str, ...]) -> list[str]:
    """The seeds and, for items shorter than the longest of them, whole items of each length."""
    return [*seeds, *[m for n in range(1, max(map(len, seeds))) if (m := "1" * n) not in seeds]]


def _slots(h: np.ndarray, mask: int, bits: int) -> np.ndarray:
    return (mix(h ^ np.uint64(0x9E3779B97F4A7C15 * (mask + 1) & (2**64 - 1))) >> np.uint64(64 - bits)).astype(np.int64)


def _tokens(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, tokens) of each text."""
    for row, end_row, data, offsets in slices(texts):
        start, end, first = runs(data, offsets, WORDS)
        tokens = token_hashes(data, start, end)
        yield from ((row + i, tokens[first[i] : first[i + 1]]) for i in range(end_row - row))


def _seed_rows(tests: DataFrame, seeds: tuple[str, ...], bits: int) -> DataFrame:
    """(mask, h, key, slot): the distinct seed hashes of test texts, and their bits of the table."""
    masks, longest = _masks(seeds), max(map(len, seeds))

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, tokens in _tokens(batch.column("text")):
                own = seeds if len(tokens) >= longest else ("1" * len(tokens),) if len(tokens) else ()
                for m in own:
                    h, k = np.unique(seed_hashes(tokens, m)), masks.index(m)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), k, np.int32)), pa.array(h.view(np.int64)), pa.array([batch.column("key")[row].as_py()] * len(h), pa.string()), pa.array(_slots(h, k, bits))], ["mask", "h", "key", "slot"])

    return tests.mapInArrow(of, "mask int, h long, key string, slot long")


def _candidates(own: DataFrame, tests: DataFrame, seeds: tuple[str, ...], test_bytes: int) -> DataFrame:
    """(row, key): documents and distinct test texts with a seed hash in common, joined by a shuffle.

    own: row, text.  The test side is hashed once and written; a bit table of bounded size goes to the executors, so that
    most hashes of documents are never shuffled.
    """
    bits = min(TABLE_BITS, max(16, (4 * test_bytes).bit_length()))
    index = cut(_seed_rows(tests, seeds, bits))
    word = index.select(F.expr("slot div 64").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("slot", F.lit(64)).cast("int")).alias("bit"))
    words = word.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # 2 ** (TABLE_BITS - 6) rows of two longs at most
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    sent, masks = own.sparkSession.sparkContext.broadcast(table), _masks(seeds)
    used = {r["mask"] for r in index.select("mask").distinct().collect()}  # as many as there are masks

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, some, hashes = [], [], []
            for at, tokens in _tokens(batch.column("text")):
                for k in sorted(used):
                    h = np.unique(seed_hashes(tokens, masks[k]))
                    slot = _slots(h, k, bits)
                    h = h[(sent.value[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1]
                    rows.append(np.full(len(h), batch.column("row")[at].as_py(), np.int64))
                    some.append(np.full(len(h), k, np.int32))
                    hashes.append(h.view(np.int64))
            cols = [np.concatenate([np.empty(0, kind), *x]) for kind, x in ((np.int64, rows), (np.int32, some), (np.int64, hashes))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["row", "mask", "h"])
            tidy()

    return own.mapInArrow(of, "row long, mask int, h long").join(index.select("mask", "h", "key"), ["mask", "h"]).select("row", "key").distinct()


def _verified(own: DataFrame, tests: DataFrame, seeds: tuple[str, ...], least: int, share: float, test_bytes: int) -> DataFrame:
    """(row, key, n_match ...): the overlaps of the candidates, each verified where its two texts meet."""
    both = _candidates(own, tests, seeds, test_bytes).join(own, "row").join(tests.withColumnRenamed("text", "item"), "key").select("row", "key", "text", "item")
    names = ["row", *[x.split()[0] for x in ROWS.split(", ")][1:]]

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, tokens in _tokens(batch.column("text")):
                key = batch.column("key")[at].as_py()
                index = TestIndex([key], [batch.column("item")[at].as_py()], seeds)
                rows += [(batch.column("row")[at].as_py(), key, *x, len(index.items[k])) for k, *x in index.found(tokens, least, share)]
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "key" else pa.int64()) for k, c in zip(names, cols, strict=True)], names=names)

    return both.mapInArrow(of, "row long, " + ROWS.split(", ", 1)[1])


def overlaps(
    docs: DataFrame, tests: DataFrame, text: str = "text", doc_id: str = "doc_id", test_text: str = "text", test_id: str = "item_id",
    min_match: int = 12, share: float = 0.8, seeds: tuple[str, ...] = SEEDS, max_test_bytes: int = MAX_TEST_BYTES,
) -> DataFrame:
    """One row for each (document row, test item) that overlap: matching tokens, aligned tokens, and where.

    Tokens are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased, so punctuation and line breaks
    do not matter.  An overlap is a stretch along one diagonal with at least ``share`` equal tokens and at least
    ``min_match`` of them, or ``share`` of an item that has fewer.  Items shorter than the longest seed are found only
    where some seed-length stretch of them, here the whole item, stands unchanged.  Of several stretches the one with
    most matches counts, the first of equals.  Null and empty texts on either side overlap nothing; repeated rows and
    items give repeated rows; ids are whole numbers or text that casts to them, and null ids stay null; other columns
    are not read; an empty table gives no rows.

    Up to ``max_test_bytes`` of distinct test text the join is done in place, against an index that every executor holds,
    and documents are not shuffled.  Beyond, documents are written once with a number; their seed hashes that pass a bit
    table of bounded size are joined with the written hashes of the tests, and only documents with a hit meet their items.
    Documents are read as often, and as much is held, whatever the size of the tests.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tests = tests.select(F.col(test_id).cast("long").alias("item_id"), F.col(test_text).alias("text"), F.md5(F.col(test_text).cast("binary")).alias("key")).where(F.length("text") > 0)
    distinct = _distinct(tests)
    size = _bytes(distinct)
    names = ["doc_id", "item_id", *[x.split()[0] for x in ROWS.split(", ")][2:]]
    if size > max_test_bytes:
        numbered = cut(own.withColumn("row", F.monotonically_increasing_id()))
        found = _verified(numbered.select("row", "text"), distinct, seeds, min_match, share, size).join(numbered.select("row", "doc_id"), "row")
    else:
        token, index = _sent(distinct)

        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _scan(batches, _opened(token, index.value, seeds), min_match, share)

        found = own.mapInArrow(scan, ROWS)
    return found.join(tests.select("key", "item_id"), "key").select(*names)


def _bytes(distinct: DataFrame) -> int:
    return distinct.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _sent(distinct: DataFrame):
    """(a name, the broadcast of keys and texts) of test texts whose size was checked."""
    rows = distinct.collect()
    return uuid.uuid4().hex, distinct.sparkSession.sparkContext.broadcast(([r["key"] for r in rows], [r["text"] for r in rows]))


def drop_contaminated(
    docs: DataFrame, tests: DataFrame, text: str = "text", test_text: str = "text", min_match: int = 12, share: float = 0.8, seeds: tuple[str, ...] = SEEDS, max_test_bytes: int = MAX_TEST_BYTES
) -> DataFrame:
    """docs without the rows that overlap a test item by the rules of overlaps(); columns stay as they are.

    Up to ``max_test_bytes`` of test text each row is judged where it is read, so nothing is shuffled; beyond, as in overlaps().
    """
    tests = tests.select(F.col(test_text).alias("text"), F.md5(F.col(test_text).cast("binary")).alias("key")).where(F.length("text") > 0)
    distinct = _distinct(tests)
    size = _bytes(distinct)
    if size <= max_test_bytes:
        token, index = _sent(distinct)
        return docs.where(_clean(index, token, seeds, min_match, share)(F.col(text)))
    numbered = cut(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row")))
    found = _verified(numbered.select("row", F.col("doc").getField(text).alias("text")), distinct, seeds, min_match, share, size)
    return numbered.join(found.select("row").distinct(), "row", "left_anti").select("doc.*")


def _clean(sent, token: str, seeds: tuple[str, ...], least: int, share: float):
    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        index, kept = _opened(token, sent.value, seeds), []
        for row, end_row, data, offsets in slices(texts):
            start, end, first = runs(data, offsets, WORDS)
            tokens = token_hashes(data, start, end)
            kept += [next(index.found(tokens[first[i] : first[i + 1]], least, share), None) is None for i in range(end_row - row)]
        tidy()
        return pa.array(kept, pa.bool_())

    return clean
