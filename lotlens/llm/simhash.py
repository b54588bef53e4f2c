"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint of 64 bits is cut into m // 2 + 1 segments, m being the largest distance: fewer than the m + 1 that exact
segment matches need.  Of m differing bits at most one lies in some segment, so two linked fingerprints agree in that
segment once the right bit is masked.  Every fingerprint is indexed under each of its 64 one-wildcard segment variants,
rows of one variant meet in an equality join, and the whole distance is verified there.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotlens.llm.components import components
from lotlens.llm.spans import tidy
from lotlens.runtime import cut

BITS = 64
SEED = 42
#: Members of one variant that a task holds at once are at most twice this; larger variants meet block by block.
BLOCK = 8192
#: Runs up to this length are compared pair by pair, longer ones by a search that visits each member once.
SHORT_RUN = 16
#: Members, and words of them, in one block of a group that is searched whole; a task holds two blocks at once.
GROUP_BLOCK, GROUP_GRAMS = 2048, 1 << 19

_SPREAD = np.array([sum(((v >> b) & 1) << (8 * b) for b in range(8)) for v in range(256)], np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """Bit i of the result is set if more than half of the hashes have it."""
    n = len(hashes)
    if not n:
        return 0
    lanes = hashes.astype("<u8").view(np.uint8).reshape(n, 8)
    starts = np.arange(0, n, 255)  # a lane of 8 bits counts to 255
    counts = [np.add.reduceat(_SPREAD[lanes[:, k]], starts).view(np.uint8).reshape(-1, 8).sum(0, np.int64) for k in range(8)]
    bits = np.concatenate(counts) * 2 > n
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash over shingles of ``width`` words, repeats included; fewer words are one shingle, none give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return majority_bits(np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64))
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(start[: len(words) - width + 1].tolist(), end[width - 1 :].tolist(), strict=True)
    return majority_bits(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64))


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3, name: str = "fp") -> DataFrame:
    """docs with a long column ``name`` (replaced if it exists): the fingerprint's 64 bits."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), width) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(name, of(F.col(text)))


def segments(most: int) -> list[tuple[int, int]]:
    """(lowest bit, number of bits) of each segment; widths differ by one at most."""
    n = most // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _variants(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(key, fp) or (key, fp, other) for every one-wildcard variant of the fingerprint, or of each of two."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            prints = [c[at : at + 2000].to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns]
            keys = []
            for which, fp in enumerate(prints):
                for low, width in segments(most):
                    value = (fp >> np.uint64(low)) & np.uint64((1 << width) - 1)
                    keys += [np.uint64((which << 38) | ((low + bit) << 32)) | (value & ~np.uint64(1 << bit)) for bit in range(width)]
            columns = [np.concatenate(keys)]
            for turn in range(len(prints)):  # the indexed fingerprint comes first
                columns.append(np.concatenate([np.tile(prints[(which + turn) % len(prints)], BITS) for which in range(len(prints))]))
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["key", "fp", "other"][: len(columns)])


def first_variant(diff: np.ndarray, most: int) -> np.ndarray:
    """For differences of at most ``most`` bits: the wildcard bit of the first variant that both fingerprints have.

    Two fingerprints may share many variants; among few members a link counts in this one only, so it is found once.
    """
    out = np.full(len(diff), -1)
    for low, width in segments(most):
        part = (diff >> np.uint64(low)) & np.uint64((1 << width) - 1)
        few = (out < 0) & (np.bitwise_count(part) <= 1)
        out[few] = low + np.log2(np.maximum(part[few], np.uint64(1)).astype(np.float64)).astype(np.int64)
    return out


def _near(fp: np.ndarray, other: np.ndarray | None, a: np.ndarray, b: np.ndarray | int, most: int, mark_bits: int) -> np.ndarray:
    """Which of the pairs (a, b) are links."""
    out = np.bitwise_count(fp[a] ^ fp[b]) <= most
    if other is not None:
        out &= np.bitwise_count(other[a] ^ other[b]) <= mark_bits
    return out


def spanning_edges(fp: np.ndarray, most: int = 3, other: np.ndarray | None = None, mark_bits: int = BITS, by: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places that join what links join, one less than there are members in each component.

    A search from each unvisited member compares the frontier with the members not yet visited only.  Members are taken
    by rising ``by`` (the fingerprint if None): runs of many variants then list the same links, to few members.
    """
    left, a, b = np.argsort(fp if by is None else by, kind="stable"), [], []
    while len(left):
        frontier, left = deque([int(left[0])]), left[1:]
        while frontier and len(left):
            at = frontier.popleft()
            near = _near(fp, other, left, at, most, mark_bits)
            if near.any():
                found = left[near]
                a.append(np.full(len(found), at))
                b.append(found)
                frontier.extend(found.tolist())
                left = left[~near]
    none = np.empty(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _verified(run: np.ndarray, bit: np.ndarray, fp: np.ndarray, other: np.ndarray | None, most: int, mark_bits: int, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between places of one run (their starts are given): in short runs each in its first variant only."""
    size = np.diff(np.append(run, len(fp)))
    a, b = [], []
    short = np.repeat(size <= SHORT_RUN, size)
    of = np.repeat(np.arange(len(run)), size)
    for d in range(1, min(SHORT_RUN, len(fp))):
        hit = np.flatnonzero((of[d:] == of[:-d]) & short[d:])
        if not len(hit):
            break
        hit = hit[_near(fp, other, hit, hit + d, most, mark_bits)]
        hit = hit[first_variant(fp[hit] ^ fp[hit + d], most) == bit[hit]]
        a.append(hit)
        b.append(hit + d)
    for i in np.flatnonzero(size > SHORT_RUN):
        own = slice(run[i], run[i] + size[i])
        x, y = spanning_edges(fp[own], most, None if other is None else other[own], mark_bits, by[own])
        a.append(x + run[i])
        b.append(y + run[i])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def whole_runs(batches: Iterable[pa.RecordBatch], keys: list[str], most_bytes: int = 8 << 20) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold runs of equal keys whole, with the starts of the runs; rows come sorted by the keys."""
    held: list[pa.RecordBatch] = []
    size = 0

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(max(0, table.num_rows - 1), bool)
        for k in keys:
            c = table[k].combine_chunks()
            new |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        return np.concatenate([[0], np.flatnonzero(new) + 1]).astype(np.int64)

    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most_bytes:
            table, size = pa.Table.from_batches(held).combine_chunks(), 0
            run = starts(table)
            if len(run) > 1:
                yield table[: run[-1]], run[:-1]
                table = table[run[-1] :]
            held = table.to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield table, starts(table)


def _meet(batches: Iterable[pa.RecordBatch], keys: list[str], most: int, mark_bits: int) -> Iterator[pa.RecordBatch]:
    """The links within runs of one variant (and one pair of blocks)."""
    for table, run in whole_runs(batches, keys):
        key = table["key"].to_numpy()
        fp = table["fp"].to_numpy().view(np.uint64)
        other = table["other"].to_numpy().view(np.uint64) if "other" in table.column_names else None
        first = fp if other is None else np.where((key >> 38) & 1 == 1, other, fp)  # the other way where the second was indexed
        a, b = _verified(run, (key >> 32) & 63, fp, other, most, mark_bits, first)
        if not len(a):
            continue
        if other is None:
            cols = [np.minimum(fp[a], fp[b]), np.maximum(fp[a], fp[b])]
        else:
            second = fp ^ other ^ first
            turn = (first[a] > first[b]) | ((first[a] == first[b]) & (second[a] > second[b]))
            a, b = np.where(turn, b, a), np.where(turn, a, b)  # one way round, whatever the variant
            cols = [first[a], second[a], first[b], second[b]]
        names = ["a", "b"] if other is None else ["a", "a_mark", "b", "b_mark"]
        yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols], names=names)
        del table
        tidy()


def _parts(own: Column, blocks: Column) -> Column:
    """The pairs of blocks in which a member of block ``own`` meets the others; the only block is a pair with itself."""
    others = F.filter(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda k: (k != own) | (blocks == 1))
    return F.transform(others, lambda k: F.least(k, own) * blocks + F.greatest(k, own))


def _heavy_variants(prints: DataFrame, most: int) -> DataFrame:
    """(key, blocks) of the variants that may hold more than BLOCK members, from exact counts of all segment values."""
    fields = [(which, name, low, width) for which, name in enumerate(prints.columns) for low, width in segments(most)]
    values = [
        F.struct(F.lit(i).alias("segment"), F.shiftrightunsigned(name, low).bitwiseAND((1 << width) - 1).alias("value"))
        for i, (_, name, low, width) in enumerate(fields)
    ]
    often = prints.select(F.explode(F.array(*values)).alias("s")).groupBy("s.segment", "s.value").count().where(F.col("count") > BLOCK // 2)
    keys = F.lit(None).cast("array<long>")
    for i, (which, _, low, width) in enumerate(fields):
        own = [F.col("value").bitwiseAND(~(1 << bit)).bitwiseOR(F.lit((which << 38) | ((low + bit) << 32))) for bit in range(width)]
        keys = F.when(F.col("segment") == i, F.array(*own)).otherwise(keys)
    # A variant joins two values; one that is not listed has BLOCK / 2 members at most.
    blocks = F.ceil((F.sum("count") + BLOCK // 2) / BLOCK).cast("long")
    return often.select(F.explode(keys).alias("key"), "count").groupBy("key").agg(blocks.alias("blocks"))


def links(distinct: DataFrame, fp: str = "fp", most: int = 3, mark: str | None = None, mark_bits: int = 16, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(a, b): verified links that connect what lies within ``most`` bits, among distinct fingerprints.

    With ``mark``, a second fingerprint, (a, a_mark, b, b_mark): both are indexed, and rows of distinct pairs are linked
    if one of the two lies within ``most`` bits and the other within ``mark_bits``.  Not every pair of a dense group is
    listed, but each component of the link graph is connected by the rows.  Variants with very many members are dealt
    to pairs of blocks; which ones is a table that is broadcast while it is small and joined by a shuffle beyond.
    """
    if not 2 <= most <= 15:
        raise ValueError("most must lie between 2 and 15: a segment has 32 bits at most and 8 at least")
    names = [fp] if mark is None else [fp, mark]
    prints = distinct.select(*names)
    variants = prints.mapInArrow(lambda it: _variants(it, most), "key long, fp long" if mark is None else "key long, fp long, other long")
    heavy, keys = cut(_heavy_variants(prints, most)), ["key"]
    n = heavy.count()
    if n:
        heavy = F.broadcast(heavy) if n * 16 <= max_broadcast_bytes else heavy
        blocks = F.coalesce("blocks", F.lit(1).cast("long"))
        own = F.pmod(F.xxhash64(*variants.columns[1:]) if mark is None else F.xxhash64(F.least("fp", "other"), F.greatest("fp", "other")), blocks)
        variants = variants.join(heavy, "key", "left").select(*variants.columns, F.explode(_parts(own, blocks)).alias("part"))
        keys = ["key", "part"]
    met = variants.repartition(*keys).sortWithinPartitions(*keys)
    out = "a long, b long" if mark is None else "a long, a_mark long, b long, b_mark long"
    return met.mapInArrow(lambda it: _meet(it, keys, most, mark_bits), out).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3, most: int = 3) -> DataFrame:
    """(doc_id, fp, component) for every row of ``docs``.

    component is the smallest id among the documents that can be reached over links of ``most`` or fewer differing bits.
    Equal fingerprints are collapsed before anything is compared, so a group of copies costs one row.  Null and empty
    texts have fingerprint 0 and are linked like any other; repeated rows stay, each with the same answer; a null id is
    larger than any other and component is null only where no row of the component has an id; an empty table gives
    none.  Other columns are not read.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = cut(fingerprints(own, "text", width, "fp").select("doc_id", "fp"))
    distinct = cut(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct, "fp", most))
    linked = cut(roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "least"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("component"))
    moved = cut(linked.select("fp", "root").join(smallest, "root").select("fp", "component"))
    classes = cut(distinct.join(moved, "fp", "left").select("fp", F.coalesce("component", "least").alias("component")))
    return own.join(classes, "fp").select("doc_id", "fp", "component")


def word_prints(text: str | None) -> tuple[int, int, int]:
    """Two independent SimHash fingerprints over the distinct words, and the number of all words.

    A changed word moves one of n features here, and ``width`` of n where shingles are the features, so texts that share
    most of their shingles lie much nearer; texts that share words only are told apart by their shingle sets later.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0, 0, 0
    halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, set(words))), "<u8").reshape(-1, 2)
    return majority_bits(np.ascontiguousarray(halves[:, 0])), majority_bits(np.ascontiguousarray(halves[:, 1])), len(words)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the shingles of ``width`` words; fewer words are one shingle.

    Two different shingles of a pair of texts are taken for one with a chance of their number over 2 ** 32.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    parts = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    return np.unique(np.fromiter((xxhash.xxh32_intdigest(p) for p in parts), np.uint32, len(parts)).view(np.int32))


def word_digest(text: str | None) -> bytes:
    """128-bit hash of the sequence of words, alike for exact copies up to A-Z case and ASCII white space."""
    return xxhash.xxh3_128_digest(b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split()))


def candidates(fp: np.ndarray, mark: np.ndarray, at: int, among: np.ndarray, most: int, mark_bits: int) -> np.ndarray:
    """Which of ``among`` lie near member ``at``: one fingerprint within ``most`` bits, the other within ``mark_bits``."""
    one, two = np.bitwise_count(fp[among] ^ fp[at]), np.bitwise_count(mark[among] ^ mark[at])
    return (np.minimum(one, two) <= most) & (np.maximum(one, two) <= mark_bits)


def verified_labels(fp: np.ndarray, mark: np.ndarray, label: np.ndarray, grams: np.ndarray, first: np.ndarray, most: int, mark_bits: int, similarity: float) -> list[tuple[int, int]]:
    """Pairs of labels that alike members join, enough to connect all labels that any such members connect.

    Member i has the distinct shingles grams[first[i] : first[i + 1]]; members of one label count as joined.  A search
    from each label compares its members with those not yet reached, and goes on from what passes all tests.
    """
    size = np.diff(first)
    ids = np.unique(grams, return_inverse=True)[1]
    own = np.zeros(len(ids), bool)
    left, out = np.arange(len(fp)), []
    while len(left):
        reached = label[left] == label[left[0]]
        frontier, left = left[reached].tolist(), left[~reached]
        while frontier and len(left):
            at = frontier.pop()
            near = candidates(fp, mark, at, left, most, mark_bits)
            near &= np.minimum(size[left], size[at]) / np.maximum(size[left], size[at]) >= similarity
            other = left[near]
            if not len(other):
                continue
            mine = ids[first[at] : first[at + 1]]
            own[mine] = True
            ends = np.cumsum(size[other])
            places = np.repeat(first[other] - ends + size[other], size[other]) + np.arange(ends[-1])
            shared = np.add.reduceat(own[ids[places]], ends - size[other], dtype=np.int64)
            own[mine] = False
            joined = np.unique(label[other[shared / (size[other] + size[at] - shared) >= similarity]])
            if len(joined):
                out.extend((int(label[at]), int(k)) for k in joined)
                reached = np.isin(label[left], joined)
                frontier.extend(left[reached].tolist())
                left = left[~reached]
    return out


def _search(batches: Iterable[pa.RecordBatch], most: int, mark_bits: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """(a, b): labels that alike members of one group, or of one pair of its blocks, join."""
    for table, run in whole_runs(batches, ["root", "part"]):
        names = table["label"].combine_chunks().dictionary_encode()
        label = names.indices.to_numpy()
        fp, mark = (table[c].to_numpy().view(np.uint64) for c in ("fp", "mark"))
        first = np.concatenate([[0], np.cumsum(pc.list_value_length(table["grams"]).to_numpy())])
        grams = pc.list_flatten(table["grams"]).to_numpy()
        found = []
        for a, b in zip(run.tolist(), [*run[1:].tolist(), table.num_rows], strict=True):
            found += verified_labels(fp[a:b], mark[a:b], label[a:b], grams[first[a] : first[b]], first[a : b + 1] - first[a], most, mark_bits, similarity)
        ends = [names.dictionary.take(pa.array([e[k] for e in found], pa.int32())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])
        del table
        tidy()


def _blocks(words: str) -> Column:
    """Blocks of a group: by its members and by their words, which bound their shingles."""
    return F.greatest(F.ceil(F.count("*") / GROUP_BLOCK), F.ceil(F.sum(words) / GROUP_GRAMS)).cast("long")


def _searched(members: DataFrame, most: int, mark_bits: int, similarity: float) -> DataFrame:
    """(a, b): labels that alike members of one group join; members: root (the group), blocks, label, node, fp, mark, grams.

    Every pair of a group is looked at.  A large group is dealt to pairs of blocks, so a task holds two blocks at most.
    """
    part = _parts(F.pmod(F.xxhash64("node"), F.col("blocks")), F.col("blocks"))
    dealt = members.select("root", F.explode(part).alias("part"), "label", "fp", "mark", "grams")
    met = dealt.repartition("root", "part").sortWithinPartitions("root", "part")
    return met.mapInArrow(lambda it: _search(it, most, mark_bits, similarity), "a binary, b binary").distinct()


def _large_groups(near: DataFrame, members: DataFrame, most: int, mark_bits: int, similarity: float) -> DataFrame:
    """(a, b): nodes that connect what alike members of large groups connect.

    The listed links are verified first.  Where all of them hold, the group is one component.  Where one fails between
    two components, all pairs of the group are tried, as pairs that were never listed lie inside a group too.
    """
    pairs = near
    for end in ("a", "b"):
        pairs = pairs.join(members.select(F.col("node").alias(end), F.col("grams").alias(f"grams_{end}")), end)
    shared = F.size(F.array_intersect("grams_a", "grams_b"))
    alike = shared / (F.size("grams_a") + F.size("grams_b") - shared) >= similarity
    tested = cut(pairs.select("a", "b", alike.alias("alike")))
    held = components(tested.where("alike"))
    labels = cut(members.select("node", "words").join(held, "node", "left").select("node", "words", F.coalesce("root", "node").alias("label")))
    failed = tested.where("not alike").select("a", "b")
    for end in ("a", "b"):
        failed = failed.join(labels.select(F.col("node").alias(end), "label"), end).drop(end).withColumnRenamed("label", end)
    failed = cut(failed.where("a <> b").distinct())
    joined = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    if failed.isEmpty():
        return joined
    groups = labels.join(components(failed).select(F.col("node").alias("label"), "root"), "label")
    sized = cut(groups.join(groups.groupBy("root").agg(_blocks("words").alias("blocks")), "root").select("node", "label", "root", "blocks"))
    more = _searched(members.drop("root", "blocks").join(sized, "node"), most, mark_bits, similarity)
    return joined.unionByName(more)


def similar_documents(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 5, similarity: float = 0.8, most: int = 7, mark_bits: int = 16, max_broadcast_bytes: int = 64 << 20
) -> DataFrame:
    """(doc_id, component) for every row: groups of texts whose sets of ``shingle``-word shingles are at least ``similarity`` alike.

    Each text has two fingerprints over its distinct words, both indexed by deletion variants.  Candidates lie within
    ``most`` bits in one of them and ``mark_bits`` in the other, which few unlike texts do, and are verified on their
    shingle sets.  Only equal sequences of words are one group at once.  All candidate pairs count, whether links() lists
    them or not: groups that links connect are searched for all alike pairs.  Verified pairs make components; component
    is the smallest id reachable.  Null and empty texts are alike; ids must not be null.

    ``most`` sets recall against cost: a variant's rows grow as n / 2 ** (64 / (most // 2 + 1) - 1).
    """

    @F.arrow_udf("struct<node binary, fp long, mark long, words int>")
    def wide(texts: pa.Array) -> pa.Array:
        found = [(word_digest(t), *word_prints(t)) for t in (x.as_py() for x in texts)]
        tidy()
        nodes, fps, marks, words = zip(*found, strict=True) if found else ((),) * 4
        prints = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fps, marks)]
        return pa.StructArray.from_arrays([pa.array(nodes, pa.binary()), *prints, pa.array(words, pa.int32())], ["node", "fp", "mark", "words"])

    @F.arrow_udf("array<int>")
    def shingles(texts: pa.Array, asked: pa.Array) -> pa.Array:
        """Null for another text than the one asked for: an id may have several."""
        out = [pa.array([], pa.list_(pa.int32()))]
        for at in range(0, len(texts), 500):
            both = ((t.as_py(), d.as_py()) for t, d in zip(texts[at : at + 500], asked[at : at + 500], strict=True))
            out.append(pa.array([shingle_set(t, shingle) if word_digest(t) == d else None for t, d in both], pa.list_(pa.int32())))
        tidy()
        return pa.concat_arrays(out)

    own = docs.select(F.col(doc_id).alias("doc_id"), wide(F.col(text)).alias("w"))
    own = cut(own.select("doc_id", "w.*"))
    nodes = cut(own.groupBy("node", "fp", "mark", "words").agg(F.min("doc_id").alias("least")))
    # One text stands for each pair of fingerprints: it is linked with the others of that pair and with near ones.
    first = cut(nodes.groupBy("fp", "mark").agg(F.min("node").alias("first"), F.count("*").alias("n")))
    near = links(first, "fp", most, "mark", mark_bits, max_broadcast_bytes)
    for end in ("a", "b"):
        near = near.join(first.select(F.col("fp").alias(end), F.col("mark").alias(f"{end}_mark"), F.col("first").alias(f"node_{end}")), [end, f"{end}_mark"])
    near = near.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    equal = nodes.join(first.where("n > 1"), ["fp", "mark"]).where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    near = cut(near.unionByName(equal))
    asked = cut(components(near).join(nodes, "node"))
    asked = asked.join(asked.groupBy("root").agg(_blocks("words").alias("blocks")), "root")
    asked = cut(asked.select("node", "root", "blocks", "fp", "mark", "words", F.col("least").alias("__id")))
    large = asked.where("blocks > 1")
    sent = F.broadcast(asked) if asked.count() * 80 <= max_broadcast_bytes else asked
    members = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(sent, F.col("doc_id") == F.col("__id"))
    names = ["node", "root", "blocks", "fp", "mark", "words"]
    members = members.select(*names, shingles("text", "node").alias("grams")).groupBy(*names).agg(F.first("grams", ignorenulls=True).alias("grams"))
    members = cut(members)
    alike = _searched(members.where("blocks = 1").withColumn("label", F.col("node")), most, mark_bits, similarity)
    if not large.isEmpty():
        inside = near.join(large.select(F.col("node").alias("a")), "a", "left_semi")
        alike = alike.unionByName(_large_groups(inside, members.where("blocks > 1"), most, mark_bits, similarity))
    linked = cut(components(alike).join(nodes, "node").select("node", "root", "least"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("component"))
    moved = cut(linked.select("node", "root").join(smallest, "root").select("node", "component"))
    classes = nodes.join(moved, "node", "left").select("node", F.coalesce("component", "least").alias("component"))
    return own.select("doc_id", "node").join(classes, "node").select("doc_id", "component")


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_broadcast_bytes: int = 64 << 20, **how) -> DataFrame:
    """The rows of docs that hold the smallest id of their group of similar_documents(); all columns stay as they are.

    Rows without an id stay.  Of repeated rows with that id all stay.  The ids that go are broadcast while they take at
    most ``max_broadcast_bytes``, which saves the shuffle of all texts; beyond, both sides are shuffled by id.
    """
    found = similar_documents(docs.where(F.col(doc_id).isNotNull()), text, doc_id, max_broadcast_bytes=max_broadcast_bytes, **how)
    gone = cut(found.where("component < doc_id").select(F.col("doc_id").alias("__gone")).distinct())
    if gone.count() * 16 <= max_broadcast_bytes:
        gone = F.broadcast(gone)
    return docs.join(gone, docs[doc_id] == gone["__gone"], "left_anti")
