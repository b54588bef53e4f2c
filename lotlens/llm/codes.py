"""Vector code compression: parts of vectors are replaced by the number of the nearest entry of a learned codebook.

Parts of integer vectors are assigned through metric trees that are built once, by the anchors method, for each block of
vectors and each part position, and are kept in a written table.  A tree's balls hold the sum and the count of their
points.  A round sends the codebook (a fixed number of integers) to all blocks; balls inherit the candidate entries of
their parent and drop those that cannot be nearest to any of their points, until one entry owns the ball and takes its
sum whole.  Distances that decide are integers, so results are exact, ties included.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from lotlens.runtime import cut

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors of a block: its trees are built and kept together.
BLOCK = 2048
#: A ball of so many points or fewer is not cut further.
LEAF = 24


@dataclass
class Tree:
    """Balls in an order that puts parents before their children; points are the distinct parts of a block."""

    points: np.ndarray  # distinct points, those of a ball side by side
    weight: np.ndarray  # rows of each point
    row_point: np.ndarray  # the point of each row of the block
    radius: np.ndarray
    first: np.ndarray  # a ball's points are first .. last
    last: np.ndarray
    total: np.ndarray  # sum and count of a ball's rows; the center is their quotient
    count: np.ndarray
    left: np.ndarray  # children, -1 for none
    right: np.ndarray

    @property
    def center(self) -> np.ndarray:
        return self.total / self.count[:, None]

    def pack(self) -> bytes:
        """The arrays as bytes, integers in the narrowest type that holds them."""
        narrow = lambda a: a if a.dtype.kind == "f" else a.astype(np.result_type(*map(np.min_scalar_type, (a.min(), a.max()))))
        return pickle.dumps([narrow(a) for a in vars(self).values()], 5)

    @classmethod
    def unpack(cls, raw: bytes) -> Tree:
        return cls(*[a if a.dtype.kind == "f" else a.astype(np.int64) for a in pickle.loads(raw)])


def _distance(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    d = points.astype(np.float64) - center
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def _anchors(points: np.ndarray, most: int) -> list[np.ndarray]:
    """The points' numbers, dealt to up to ``most`` anchors: each new anchor is the point farthest from its own anchor, and
    takes the points that are nearer to it; an anchor whose points all lie within half the way to it is not looked at."""
    far = _distance(points, points[0].astype(np.float64))
    owned, dist, pivot = [np.argsort(-far, kind="stable")], [np.sort(far)[::-1]], [points[0]]
    while len(owned) < most:
        widest = max(range(len(owned)), key=lambda k: dist[k][0])
        if dist[widest][0] == 0:
            break
        new = points[owned[widest][0]]
        taken, taken_dist = [], []
        for k in range(len(owned)):
            half = math.dist(new.tolist(), pivot[k].tolist()) / 2
            reach = int(np.searchsorted(-dist[k], -half * (1 - 1e-9), "right"))  # points nearer than half the way stay
            if not reach:
                continue
            at = owned[k][:reach]
            d = _distance(points[at], new.astype(np.float64))
            moves = d < dist[k][:reach]
            if moves.any():
                taken.append(at[moves])
                taken_dist.append(d[moves])
                stay = np.r_[~moves, np.ones(len(owned[k]) - reach, bool)]
                owned[k], dist[k] = owned[k][stay], dist[k][stay]
        at, d = np.concatenate(taken), np.concatenate(taken_dist)
        order = np.argsort(-d, kind="stable")
        owned.append(at[order])
        dist.append(d[order])
        pivot.append(new)
        kept = [k for k in range(len(owned)) if len(owned[k])]
        owned, dist, pivot = ([x[k] for k in kept] for x in (owned, dist, pivot))
    return owned


class _Grown:
    """Collects a tree middle-out: anchors first, then balls above them by pairs, and anchors again within each."""

    def __init__(self, points: np.ndarray, weight: np.ndarray):
        self.points, self.weight, self.order, self.balls = points, weight, [], []

    def ball(self, at: np.ndarray, children: tuple[int, int] = (-1, -1)) -> int:
        pts, w = self.points[at], self.weight[at]
        total, count = (pts * w[:, None]).sum(0), int(w.sum())
        center = total / count
        self.balls.append((at, center, float(_distance(pts, center).max()), total, count, children))
        return len(self.balls) - 1

    def grow(self, at: np.ndarray) -> int:
        """The number of a ball over the points ``at``."""
        groups = [at] if len(at) <= LEAF else [at[g] for g in _anchors(self.points[at], max(2, math.isqrt(len(at))))]
        if len(groups) == 1:
            return self.ball(at)
        tops = [self.grow(g) for g in groups]
        centers = np.array([self.balls[t][1] for t in tops])
        radii = np.array([self.balls[t][2] for t in tops])
        cost = np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(-1)) + radii[:, None] + radii[None]
        np.fill_diagonal(cost, np.inf)
        for _ in range(len(tops) - 1):  # the pair that makes the smallest ball
            a, b = divmod(int(cost.argmin()), len(tops))
            tops[a] = self.ball(np.concatenate([self.balls[tops[a]][0], self.balls[tops[b]][0]]), (tops[a], tops[b]))
            cost[b, :] = cost[:, b] = np.inf
            centers[a], radii[a] = self.balls[tops[a]][1], self.balls[tops[a]][2]
            alive = np.isfinite(cost[a])
            new = np.sqrt(((centers - centers[a]) ** 2).sum(-1)) + radii + radii[a]
            cost[a, alive] = cost[alive, a] = new[alive]
        return tops[a]


def tree_of(parts: np.ndarray) -> Tree:
    """The tree over the rows of ``parts`` (integers); equal rows are one point with a weight."""
    points, row_point, weight = np.unique(parts, axis=0, return_inverse=True, return_counts=True)
    grown = _Grown(points, weight)
    root = grown.grow(np.arange(len(points)))
    numbers, queue = [], [root]
    while queue:  # parents before children
        numbers.append(queue.pop())
        queue += [c for c in grown.balls[numbers[-1]][5][::-1] if c >= 0]
    new = {old: k for k, old in enumerate(numbers)}
    order, first = [], {}
    for old in numbers:
        if grown.balls[old][5][0] < 0:
            first[old] = sum(map(len, order))
            order.append(grown.balls[old][0])
    for old in reversed(numbers):
        if old not in first:
            first[old] = first[grown.balls[old][5][0]]
    placed = np.concatenate(order)
    where = np.empty(len(points), np.int64)
    where[placed] = np.arange(len(points))
    balls = [grown.balls[old] for old in numbers]
    start = np.array([first[old] for old in numbers])
    return Tree(
        points[placed], weight[placed], where[row_point.reshape(-1)], np.array([b[2] for b in balls]), start, start + np.array([len(b[0]) for b in balls]),
        np.array([b[3] for b in balls]), np.array([b[4] for b in balls]), np.array([new.get(b[5][0], -1) for b in balls]), np.array([new.get(b[5][1], -1) for b in balls]),
    )


def nearest(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of each point, sums and counts of each entry's rows): the nearest entry, ties to the lower number.

    Balls are visited level by level, each with the candidates that its parent left.
    """
    owner, center = np.full(len(tree.points), -1, np.int64), tree.center
    sums, counts = np.zeros_like(entries), np.zeros(len(entries), np.int64)
    alone = np.zeros(len(entries), bool)
    alone[np.unique(entries, axis=0, return_index=True)[1]] = True  # of equal entries only the first can win
    balls, mask, where = np.array([0]), alone[None], entries.astype(np.float64)
    while len(balls):
        d = np.sqrt(((center[balls][:, None] - where[None]) ** 2).sum(-1))
        closest = np.where(mask, d, np.inf).min(1)
        slack = 1e-9 * (closest + tree.radius[balls] + 1)
        mask = mask & (d <= (closest + 2 * tree.radius[balls] + slack)[:, None] * (1 + 1e-9))
        owned = mask.sum(1) == 1
        for ball, entry in zip(balls[owned], mask[owned].argmax(1), strict=True):
            owner[tree.first[ball] : tree.last[ball]] = entry
            sums[entry] += tree.total[ball]
            counts[entry] += tree.count[ball]
        rest = ~owned
        leaf = rest & (tree.left[balls] < 0)
        for ball, allowed in zip(balls[leaf], mask[leaf], strict=True):
            at, few = slice(tree.first[ball], tree.last[ball]), np.flatnonzero(allowed)
            pts = tree.points[at]
            own = few[((pts[:, None] - entries[few][None]) ** 2).sum(-1).argmin(1)]
            owner[at] = own
            np.add.at(sums, own, pts * tree.weight[at][:, None])
            np.add.at(counts, own, tree.weight[at])
        inner = rest & ~leaf
        balls, mask = np.concatenate([tree.left[balls[inner]], tree.right[balls[inner]]]), np.concatenate([mask[inner], mask[inner]])
    return owner, sums, counts


def largest_component(length: int) -> int:
    """Components beyond this, either way, are taken as this: squared errors of a vector must fit a long."""
    return math.isqrt(2**62 // max(1, length)) // 2


def _blocks(kept: DataFrame, length: int) -> DataFrame:
    """Rows (rows array<struct>, trees array<binary>): blocks of vectors in the order of the scan, with a tree for each part."""
    edge = largest_component(length)

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_rows = [], 0

        def block(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column(1)
            wide = np.zeros((batch.num_rows, length))
            sizes = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            wide[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy(zero_copy_only=False)
            whole = np.clip(np.floor(np.clip(wide, -edge, edge) * SCALE), -edge, edge).astype(np.int64)
            trees = [tree_of(p).pack() for p in np.split(whole, PARTS, 1)]
            rows = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
            return pa.RecordBatch.from_arrays([rows, pa.array([trees], pa.list_(pa.binary()))], ["rows", "trees"])

        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(a, BLOCK)
                held.append(piece)
                held_rows += piece.num_rows
                if held_rows >= BLOCK:
                    yield block(_joined(held))
                    held, held_rows = [], 0
        if held_rows:
            yield block(_joined(held))

    kind = kept.schema["row"].dataType
    return kept.mapInArrow(of, StructType([StructField("rows", ArrayType(kind)), StructField("trees", ArrayType(BinaryType()))]))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


@dataclass
class Model:
    """codebooks: for each part an array of entries; blocks: the written table of blocks with their trees."""

    codebooks: np.ndarray
    blocks: DataFrame
    kept: tuple[str, ...] = ()

    def digest(self) -> str:
        """SHA-256 of all components as decimal text, by part, entry and place."""
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Whether a vector has components and all of them are finite numbers."""
    value = lambda x: x.cast("double")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def learn(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = (), entries: int = ENTRIES, rounds: int = ROUNDS) -> Model:
    """Codebooks of all usable vectors, after ``rounds`` rounds from the parts of the vectors with the smallest keys.

    Rows whose vector is null, empty, or holds a null or non-finite component are left out.  Components become
    floor(256 x).  Vectors of less than the greatest length, or of one that 16 does not divide, are filled with zeros;
    components beyond ``largest_component`` are taken as that.  Null keys come last, rows that repeat a key are ordered
    by their vector.  Fewer vectors than entries make fewer entries; an entry that nothing is assigned to stays; no
    vectors make empty codebooks.  ``keep`` names columns that go along, with any names.
    """
    col = lambda name: F.col(f"`{name}`")
    row = F.struct(col(key).alias("key"), F.struct(*[col(c).alias(c) for c in keep] or [F.lit(None).cast("int").alias("none")]).alias("kept"))
    kept = vectors.select(row.alias("row"), col(vector).cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    length = -(-longest // PARTS) * PARTS
    edge = largest_component(length)
    first = kept.orderBy(F.col("row.key").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    start = np.zeros((len(first), length))
    for k, r in enumerate(first):
        start[k, : len(r.vector)] = r.vector
    whole = np.clip(np.floor(np.clip(start, -edge, edge) * SCALE), -edge, edge).astype(np.int64)
    books = whole.reshape(len(first), PARTS, length // PARTS).transpose(1, 0, 2)
    blocks = cut(_blocks(kept, length))
    for _ in range(rounds if len(first) else 0):
        books = _moved(blocks, books)
    return Model(books, blocks, tuple(keep))


def _moved(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry at the floor of the mean of its parts."""
    many, width = books.shape[1:]

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for trees in batch.column(0):
                for part, tree in enumerate(trees):
                    _, sums, counts = nearest(Tree.unpack(tree.as_py()), books[part])
                    total[part] += sums
                    count[part] += counts
        part, entry = np.nonzero(count)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(total[part, entry].reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), sums, pa.array(count[part, entry])], ["part", "entry", "sums", "n"])

    found = blocks.select("trees").mapInArrow(of, "part int, entry int, sums array<long>, n long")
    each = found.select("part", "entry", "n", F.posexplode("sums").alias("place", "s")).groupBy("part", "entry", "place").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    new = books.copy()
    for r in each.collect():  # one row for each component of the codebooks
        new[r.part, r.entry, r.place] = r.s // r.n
    return new


def encode(model: Model, key: str = "vec_id") -> DataFrame:
    """(key, kept columns, code, error): the entry of each part as two hex digits (more beyond 256 entries) and the squared distances' sum.

    A row for each vector that ``learn`` took.
    """
    books = model.codebooks
    digits = max(2, len(f"{max(0, books.shape[1] - 1):x}"))
    names = np.array([f"{k:0{digits}x}" for k in range(max(1, books.shape[1]))])

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch.column(0).slice(k, 1).flatten()
                code, error = np.full(len(rows), "", dtype=object), np.zeros(len(rows), np.int64)
                for part, raw in enumerate(batch.column(1)[k]):
                    tree = Tree.unpack(raw.as_py())
                    owner, _, _ = nearest(tree, books[part])
                    off = ((tree.points - books[part][owner]) ** 2).sum(1)
                    code = code + names[owner][tree.row_point].astype(object)
                    error += off[tree.row_point]
                yield pa.RecordBatch.from_arrays([rows, pa.array(code.tolist(), pa.string()), pa.array(error)], ["row", "code", "error"])

    kind = model.blocks.schema["rows"].dataType.elementType
    found = model.blocks.select("rows", "trees").mapInArrow(of, StructType([StructField("row", kind), StructField("code", StringType()), StructField("error", LongType())]))
    extra = [F.col("row.kept").getField(c).alias(c) for c in model.kept]
    return found.select(F.col("row.key").alias(key), *extra, "code", "error")


def decode(codes: DataFrame, model: Model, code: str = "code") -> DataFrame:
    """codes with ``vector``: the components that a code stands for, scaled back; a null code gives null."""
    books = model.codebooks
    digits = max(2, len(f"{max(0, books.shape[1] - 1):x}"))

    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            at = text is not None and [int(text[k : k + digits], 16) for k in range(0, len(text), digits)]
            out.append(None if text is None else (np.concatenate([books[p][e] for p, e in enumerate(at)]) / SCALE).tolist())
        return pa.array(out, pa.list_(pa.float64()))

    return codes.withColumn("vector", of(code))
