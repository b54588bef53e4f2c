"""Line deduplication with a sharded minimal perfect hash.

Distinct line hashes are counted over all documents in one pre-aggregated shuffle.  The hashes of lines that stand in
more than one document go into shards; each shard gets a minimal perfect hash that indexes flat arrays of fingerprints,
counts and the document to keep.  Documents then probe the arrays, and lines are never joined: up to a size the shards
go to every executor, beyond it the line hashes of each document go to their shard.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotlens.llm.spans import mix, tidy
from lotlens.runtime import cut

#: Hashes in a shard, and the bytes of all shards up to which they are sent to every executor.
SHARD_KEYS = 32_768
MAX_INDEX_BYTES = 128 << 20
#: Bytes a key: fingerprint 8, count 4, document 8, and under 6 bits of hash with its ranks.
KEY_BYTES = 21
#: Lines that probe one copy of a shard, at most about.
PROBES = 1_000_000
_SPACE = b" \t\n\x0b\x0c\r"
_NONE = np.iinfo(np.int64).min


#: From this level on a key's second hash counts too: keys that are equal in the first one part there.
_SECOND_LEVEL, _MOST_LEVELS = 8, 200


class PerfectHash:
    """Minimal perfect hash of distinct pairs of 64-bit keys: levels of bit arrays, each key marked at the first level where it is alone.

    ``words`` are the bits of all levels in 64-bit words, ``ranks`` the marked bits before each word.  Few keys are left
    when the second key begins to count, so it is rarely looked at.
    """

    def __init__(self, sizes: list[int], words: np.ndarray, ranks: np.ndarray):
        self.sizes, self.words, self.ranks = sizes, words, ranks

    @classmethod
    def of(cls, keys: np.ndarray, second: np.ndarray) -> PerfectHash:
        sizes, words, left, more = [], [np.empty(0, np.uint64)], keys, second
        while len(left):
            if len(sizes) == _MOST_LEVELS:
                raise ValueError("keys repeat")
            size = max(64, -(-2 * len(left) // 64) * 64)
            at = cls._place(left, more, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left, more = left[~alone[at]], more[~alone[at]]
        bits = np.concatenate(words)
        ranks = np.cumsum(np.bitwise_count(bits), dtype=np.int32) - np.bitwise_count(bits).astype(np.int32)
        return cls(sizes, bits, ranks)

    @staticmethod
    def _place(keys: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
        step = np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1))
        own = keys + step if level < _SECOND_LEVEL else keys ^ mix(second + step)
        return (mix(own) % np.uint64(size)).astype(np.int64)

    def __call__(self, keys: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slot of each key; for what is no key, some slot or -1."""
        slot = np.full(len(keys), -1, np.int64)
        left, before = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = before + self._place(keys[left], second[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[left[hit]] = self.ranks[at[hit] >> 6] + below[hit]
            left, before = left[~hit], before + size
        return slot


class Shard:
    """The arrays of one shard in slot order."""

    def __init__(self, index: PerfectHash, mark: np.ndarray, count: np.ndarray, keep: np.ndarray):
        self.hash, self.mark, self.count, self.keep = index, mark, count, keep

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray, count: np.ndarray, keep: np.ndarray) -> Shard:
        index = PerfectHash.of(h1, h2)
        order = np.argsort(index(h1, h2))
        return cls(index, h2[order], np.minimum(count, 2**31 - 1).astype(np.int32)[order], keep[order])

    def pack(self) -> bytes:
        sizes = self.hash.sizes
        head = np.array([len(self.mark), len(sizes), *sizes], np.int64)
        return b"".join(x.tobytes() for x in (head, self.mark, self.keep, self.hash.words, self.hash.ranks, self.count))

    @classmethod
    def unpack(cls, data: bytes) -> Shard:
        """Views of the packed bytes, nothing is copied."""
        n, levels = np.frombuffer(data, np.int64, 2).tolist()
        sizes, at = np.frombuffer(data, np.int64, levels, 16).tolist(), 16 + 8 * levels
        out = []
        for kind, length in ((np.uint64, n), (np.int64, n), (np.uint64, sum(sizes) // 64), (np.int32, sum(sizes) // 64), (np.int32, n)):
            out.append(np.frombuffer(data, kind, length, at))
            at += out[-1].nbytes
        mark, keep, words, ranks, count = out
        return cls(PerfectHash(sizes, words, ranks), mark, count, keep)

    def drops(self, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
        """Whether the line with these hashes goes from document ``doc``."""
        slot = self.hash(h1, h2)
        known = slot >= 0
        known[known] = (self.mark[slot[known]] == h2[known]) & (self.count[slot[known]] >= least)
        known[known] = self.keep[slot[known]] != doc[known]
        return known


def line_hashes(line: bytes, min_chars: int) -> tuple[int, int] | None:
    """The two hashes of a line's key: stripped of ASCII white space, A-Z lower-cased; None if the key is too short."""
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "surrogatepass")) < min_chars):
        return None
    h = xxhash.xxh3_128_intdigest(key)
    return h >> 64, h & 0xFFFFFFFFFFFFFFFF


def _lines_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def _seen(batches: Iterable[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(h1, h2, doc) for each distinct long line of each document."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            h1, h2, doc = [], [], []
            for text, doc_id in zip(batch.column("text")[at : at + 1000], batch.column("doc_id")[at : at + 1000].to_pylist(), strict=True):
                found = {line_hashes(x, min_chars) for x in _lines_of(text.as_py())} - {None}
                h1 += [x[0] for x in found]
                h2 += [x[1] for x in found]
                doc += [doc_id] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (h1, h2)] + [pa.array(doc, pa.int64())], names=["h1", "h2", "doc"])
        del batch, text
        tidy()


def _build(table: pa.Table) -> pa.Table:
    """One row with the packed arrays of a shard."""
    col = lambda name: table[name].to_numpy()
    shard = Shard.of(col("h1").view(np.uint64), col("h2").view(np.uint64), col("n"), col("keep"))
    return pa.table({"shard": table["shard"][:1], "lines": pa.array([int(col("n").sum())], pa.int64()), "arrays": pa.array([shard.pack()], pa.binary())})


def _dropped(hashes: list, doc_ids: list, shards: dict[int, Shard], n_shards: int, least: int) -> list[np.ndarray]:
    """For each document a mask of its lines that go."""
    sizes = [len(x) for x in hashes]
    flat = [(i, h) for i, h in enumerate(h for x in hashes for h in x) if h is not None]
    gone = np.zeros(sum(sizes), bool)
    if flat and shards:
        at = np.array([i for i, _ in flat])
        h1, h2 = (np.array([h[k] for _, h in flat], np.uint64) for k in (0, 1))
        doc = np.repeat(np.array([_NONE if d is None else d for d in doc_ids], np.int64), sizes)[at]
        of = (h1.view(np.int64) % n_shards).astype(np.int64)
        for s in np.unique(of):
            if int(s) in shards:
                here = of == s
                gone[at[here]] = shards[int(s)].drops(h1[here], h2[here], doc[here], least)
    return np.split(gone, np.cumsum(sizes)[:-1]) if sizes else []


_RESULT = "struct<text string, n_lines long, n_dropped long>"


def _kept(lines: list[list[bytes]], gone: list[np.ndarray]) -> pa.Array:
    """The lines that stay, joined, and the numbers of lines before and dropped."""
    out, n_lines, n_dropped = [], [], []
    for ls, g in zip(lines, gone, strict=True):
        kept = ls if not g.any() else [x for x, off in zip(ls, g.tolist(), strict=True) if not off]
        out.append(b"\n".join(kept).decode("utf-8", "surrogatepass"))
        n_lines.append(len(ls))
        n_dropped.append(len(ls) - len(kept))
    return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], ["text", "n_lines", "n_dropped"])


_EMPTY = _kept([], [])


def repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_docs: int = 2, min_chars: int = 40) -> DataFrame:
    """(h1, h2, n, keep): the 128-bit hash of each long line in at least ``min_docs`` rows, their number, the largest id."""
    own = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"))
    seen = own.mapInArrow(lambda it: _seen(it, min_chars), "h1 long, h2 long, doc long")
    counted = seen.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc").alias("keep"))
    return counted.where(F.col("n") >= min_docs).withColumn("keep", F.coalesce("keep", F.lit(_NONE)))


def dedup_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_docs: int = 5, min_chars: int = 40, max_index_bytes: int = MAX_INDEX_BYTES
) -> DataFrame:
    """docs with ``text`` rid of repeated lines, and longs n_lines (before) and n_dropped; such columns are replaced.

    A text is split at newlines; a null or empty one is one empty line and comes back empty.  A line's key is the line
    without ASCII white space at its ends, A-Z lower-cased.  A key of ``min_chars`` code points or more that ``min_docs``
    or more rows hold loses its lines everywhere but in rows with the largest id that holds it, where all of them stay.
    Rows are documents, repeated rows too; ids are whole numbers or text that casts to them (else the query fails), and
    a null id is smaller than any other.  Other columns pass unchanged and rows are never dropped; an empty table stays empty.

    The index goes to every executor while it has at most ``max_index_bytes``.  Beyond that each line's hash goes to its
    shard and probes the same arrays there; a shard that many lines probe is sent to several partitions.
    """
    hot = cut(repeated_lines(docs, text, doc_id, min(min_docs, 2), min_chars))
    n = hot.count()
    n_shards = max(1, -(-n // SHARD_KEYS))
    built = hot.withColumn("shard", F.pmod("h1", F.lit(n_shards))).groupBy("shard").applyInArrow(_build, "shard long, lines long, arrays binary")
    if n * KEY_BYTES > max_index_bytes:
        return _at_shards(docs, cut(built), n_shards, text, doc_id, min_docs, min_chars)
    index = docs.sparkSession.sparkContext.broadcast({r["shard"]: r["arrays"] for r in built.collect()})  # bounded above
    opened: dict[int, Shard] = {}

    @F.arrow_udf(_RESULT)
    def rid(texts: pa.Array, ids: pa.Array) -> pa.Array:
        if index.value and not opened:
            opened.update({k: Shard.unpack(v) for k, v in index.value.items()})
        out = [_EMPTY]
        for at in range(0, len(texts), 500):
            lines = [_lines_of(t.as_py()) for t in texts[at : at + 500]]
            hashes = [[line_hashes(x, min_chars) for x in ls] for ls in lines]
            out.append(_kept(lines, _dropped(hashes, ids[at : at + 500].to_pylist(), opened, n_shards, min_docs)))
        tidy()
        return pa.concat_arrays(out)

    return _replaced(docs.select(_row(docs), rid(F.col(text), F.col(doc_id).cast("long")).alias("rid")), text)


def _row(docs: DataFrame) -> Column:
    """All columns as one, so that they may have any names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _replaced(found: DataFrame, text: str) -> DataFrame:
    """The columns of ``row`` with the text and the counts of ``rid``."""
    own = [c for c in found.schema["row"].dataType.names if c not in ("n_lines", "n_dropped")]
    return found.select(*[F.col("rid.text").alias(text) if c == text else F.col("row").getField(c).alias(c) for c in own], "rid.n_lines", "rid.n_dropped")


def _probe(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(row, pos) of lines that go.  In the sorted rows each copy of a shard comes before the lines that probe it."""
    shard = None
    for batch in batches:
        arrays = batch.column("arrays")
        cuts = np.flatnonzero(arrays.is_valid().to_numpy(zero_copy_only=False)).tolist()
        col = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "doc", "row", "pos")}
        for a, b in zip([-1, *cuts], [*cuts, batch.num_rows], strict=True):
            if a >= 0:
                shard = Shard.unpack(arrays[a].as_py())
            if b > a + 1:
                h1, h2, doc, row, pos = (col[c][a + 1 : b] for c in col)
                gone = shard.drops(h1.view(np.uint64), h2.view(np.uint64), doc, least)
                yield pa.RecordBatch.from_arrays([pa.array(row[gone]), pa.array(pos[gone])], names=["row", "pos"])


def _at_shards(docs: DataFrame, built: DataFrame, n_shards: int, text: str, doc_id: str, min_docs: int, min_chars: int) -> DataFrame:
    """The same result where the index is too large to send: the hashes of lines go to their shards."""

    @F.arrow_udf("array<struct<pos long, h1 long, h2 long>>")
    def spots(texts: pa.Array) -> pa.Array:
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        kind, out = pa.list_(pa.struct([("pos", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])), []
        for t in texts:
            hs = enumerate(line_hashes(x, min_chars) for x in _lines_of(t.as_py()))
            out.append([{"pos": i, "h1": signed(h[0]), "h2": signed(h[1])} for i, h in hs if h])
        return pa.array(out, kind)

    @F.arrow_udf(_RESULT)
    def rid(texts: pa.Array, gone: pa.Array) -> pa.Array:
        out = [_EMPTY]
        for at in range(0, len(texts), 500):
            lines = [_lines_of(t.as_py()) for t in texts[at : at + 500]]
            masks = [np.isin(np.arange(len(ls)), g or []) for ls, g in zip(lines, gone[at : at + 500].to_pylist(), strict=True)]
            out.append(_kept(lines, masks))
        return pa.concat_arrays(out)

    keyed = cut(docs.select(_row(docs), F.monotonically_increasing_id().alias("at")))
    body, own_id = F.col("row").getField(text), F.col("row").getField(doc_id)
    copies = built.select("shard", F.ceil(F.col("lines") / PROBES).cast("long").alias("copies"))  # one short row a shard
    lines = keyed.select(F.col("at").alias("row"), F.coalesce(own_id.cast("long"), F.lit(_NONE)).alias("doc"), F.explode(spots(body)).alias("s"))
    lines = lines.select("row", "doc", "s.*", F.pmod("s.h1", F.lit(n_shards)).alias("shard")).join(F.broadcast(copies), "shard")
    lines = lines.select("shard", F.pmod(F.xxhash64("row", "pos"), F.col("copies")).alias("copy"), F.lit(1).alias("turn"), F.lit(None).cast("binary").alias("arrays"), "h1", "h2", "doc", "row", "pos")
    zero = F.lit(0).cast("long")
    every = F.explode(F.sequence(zero, F.ceil(F.col("lines") / PROBES).cast("long") - 1))
    sent = built.select("shard", every.alias("copy"), F.lit(0).alias("turn"), "arrays", *[zero.alias(c) for c in ("h1", "h2", "doc", "row", "pos")])
    met = lines.unionByName(sent).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "turn")
    gone = met.mapInArrow(lambda it: _probe(it, min_docs), "row long, pos long")
    gone = gone.groupBy(F.col("row").alias("at")).agg(F.collect_list("pos").alias("gone"))
    return _replaced(keyed.join(gone, "at", "left").select("row", rid(body, F.col("gone")).alias("rid")), text)
