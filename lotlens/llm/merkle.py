"""Merkle manifest of a dataset: a tree of row digests under each group, and a tree of the groups' roots.

The levels are built by grouped aggregates over ranks that no task computes for a whole group, and stored as node rows
with a link to their parent and the digests of their children.  A proof is made and checked by a recursive query: the
leaves of a run climb from parent to parent, each folding its own digest, and gather the siblings on the way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotlens.runtime import cut

FANOUT = 8
_ROW_LIMIT, _LEVEL_LIMIT = "spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit"


def hashed(text: Column) -> Column:
    """SHA-256 as bytes; digests inside ``text`` are lower-case hex."""
    return F.unhex(F.sha2(text, 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def encoded(col: Column) -> Column:
    """A value with its length in bytes before it, ``-`` for null: no two rows of values are written alike."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: list[Column]) -> Column:
    return hashed(F.concat(*map(encoded, columns)))


def _ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with ``idx``, the place in the order of the group from 0, and ``n``, the group's size.

    rows must be a written table: it is dealt by ranges of (group, order, place in the table), so that neither a large
    group nor many equal rows are one range.
    """
    by = [F.col(c).asc_nulls_first() for c in [group, *order]] + [F.monotonically_increasing_id()]
    dealt = cut(rows.repartitionByRange(*by).withColumn("part", F.spark_partition_id()))
    counts = dealt.groupBy(group, "part").agg(F.count(F.lit(1)).alias("here"))
    counts = counts.selectExpr(f"`{group}` as g", "part as p", f"sum(here) over (partition by `{group}` order by part) - here as before", f"sum(here) over (partition by `{group}`) as n")
    inside = dealt.selectExpr("*", f"row_number() over (partition by part, `{group}` order by {', '.join(f'`{c}` nulls first' for c in order)}) - 1 as place")
    both = inside.join(counts, inside[group].eqNullSafe(counts["g"]) & (inside["part"] == counts["p"]))
    return both.select(*rows.columns, (F.col("before") + F.col("place")).alias("idx"), "n")


def _height(n: Column) -> Column:
    """Levels above the leaves until one node is left."""
    steps = F.lit(0)
    for k in range(20):
        steps = F.when(n > FANOUT**k, k + 1).otherwise(steps)
    return steps


def _node(tree: Column, level: Column | int, idx: Column) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    return F.concat(level.cast("string"), F.lit("/"), idx.cast("string"), F.lit("/"), tree)


def _levels(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(inner nodes, roots) of the trees whose leaves are ``nodes`` (tree, idx, n, digest).

    Inner nodes are (node, parent, pos, children): parent and pos are null for a tree's root.  Roots are (tree, digest, node);
    a lone leaf is its own root, without a node.
    """
    level = nodes.select("tree", "idx", "digest", _height(F.col("n")).alias("height"))
    most = level.agg(F.max("height")).first()[0] or 0
    lone = level.where("height = 0").select("tree", "digest", F.lit(None).cast("string").alias("node"))
    inner, roots = None, lone
    for k in range(1, most + 1):
        below = level.where(F.col("height") >= k).withColumn("up", F.floor(F.col("idx") / FANOUT).cast("long"))
        runs = below.groupBy("tree", "height", "up").agg(F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("run"))  # eight at most
        runs = runs.withColumn("children", F.aggregate("run", F.lit(b"").cast("binary"), lambda all, x: F.concat(all, x["digest"])))
        level = cut(runs.select("tree", F.col("up").alias("idx"), hashed(as_hex(F.col("children"))).alias("digest"), "height", "children"))
        top = F.col("height") == k
        up = F.floor(F.col("idx") / FANOUT).cast("long")
        made = level.select(_node(F.col("tree"), k, F.col("idx")).alias("node"), F.when(~top, _node(F.col("tree"), k + 1, up)).alias("parent"), F.when(~top, F.pmod("idx", F.lit(FANOUT))).cast("int").alias("pos"), "children")
        inner = made if inner is None else inner.unionByName(made)
        roots = roots.unionByName(level.where(top).select("tree", "digest", _node(F.col("tree"), k, F.col("idx")).alias("node")))
        level = level.where(~top).drop("children")
    if inner is None:
        inner = roots.select("node", F.col("node").alias("parent"), F.lit(0).alias("pos"), F.col("digest").alias("children")).where("false")
    return inner, roots


@dataclass
class Manifest:
    """leaves (group, the columns given, leaf, parent, pos, subroot), nodes (node, parent, pos, children), and the root."""

    leaves: DataFrame
    nodes: DataFrame
    root: bytes | None


def build(rows: DataFrame, group: str, order: str, leaf: str = "leaf", keep: list[str] | None = None) -> Manifest:
    """The manifest of rows (leaf digests as bytes), with a tree for each value of ``group`` in ascending ``order``.

    Nulls come first in both orders and a null group is a group; groups may be many.  Rows that repeat an order value are
    ordered by leaf.  An empty table has no root.  ``keep`` names further columns of the leaves.
    """
    keep = keep or []
    tree = F.concat(F.when(F.col(f"`{group}`").isNull(), "0").otherwise("1"), F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("")))
    own = cut(rows.select(tree.alias("tree"), F.col(f"`{order}`").alias("key"), F.col(f"`{leaf}`").alias("digest"), F.struct(*[F.col(f"`{c}`") for c in [group, *keep]]).alias("row")))
    ranked = cut(_ranked(own, "tree", ["key", "digest"]))
    inner, roots = _levels(ranked)
    # "0" comes before "1", and text after it is ordered by its bytes: null first, then bytewise
    tops = cut(_ranked(cut(roots.select(F.lit("top").alias("trees"), "tree", "digest", "node")), "trees", ["tree"]))
    above, summit = _levels(tops.select(F.lit("top").alias("tree"), "idx", "n", "digest"))
    many = F.col("n") > 1
    linked = tops.select("tree", F.col("digest").alias("subroot"), "node", F.when(many, _node(F.lit("top"), 1, F.floor(F.col("idx") / FANOUT).cast("long"))).alias("parent"), F.when(many, F.pmod("idx", F.lit(FANOUT))).cast("int").alias("pos"))
    linked = cut(linked)
    ends = linked.where("node is not null").selectExpr("node", "parent as top_parent", "pos as top_pos")
    nodes = inner.join(ends, "node", "left").select("node", F.coalesce("parent", "top_parent").alias("parent"), F.coalesce("pos", "top_pos").alias("pos"), "children").unionByName(above)
    first = summit.select("digest").take(1)
    grouped = linked.selectExpr("tree", "subroot", "parent as top_parent", "pos as top_pos")
    found = ranked.join(grouped, "tree")
    inside = F.col("n") > 1
    leaves = found.select(
        "row.*", F.col("key").alias(order), F.col("digest").alias(leaf), "subroot",
        F.when(inside, _node(F.col("tree"), 1, F.floor(F.col("idx") / FANOUT).cast("long"))).otherwise(F.col("top_parent")).alias("parent"),
        F.when(inside, F.pmod("idx", F.lit(FANOUT)).cast("int")).otherwise(F.col("top_pos")).alias("pos"),
    )
    return Manifest(leaves, cut(nodes), bytes(first[0][0]) if first else None)


_LEFT, _RIGHT = "substring({c}, 1, 32 * {p})", "substring({c}, 32 * {p} + 33)"
_CLIMB = f"""
with recursive climb as (
  select run, parent, pos, folded, unhex('') as siblings from {{start}}
  union all
  select c.run, n.parent, n.pos,
         transform(c.folded, f -> unhex(sha2(lower(hex(concat({_LEFT.format(c="n.children", p="c.pos")}, f, {_RIGHT.format(c="n.children", p="c.pos")}))), 256))),
         concat(c.siblings, {_LEFT.format(c="n.children", p="c.pos")}, {_RIGHT.format(c="n.children", p="c.pos")})
  from climb c join {{nodes}} n on c.parent = n.node)
select run, folded, siblings from climb where parent is null"""


def prove(manifest: Manifest, shown: str, leaf: str = "leaf", key: str = "doc_id") -> DataFrame:
    """The leaves with ``proof`` (all siblings up to the root, left to right, as bytes) and ``folded``: the root that the digest in ``shown`` leads to.

    The leaves of a run differ in their own siblings only, so they climb in one row, each with its own folded digest; the
    climb has an eighth of the leaves' rows at each level.  The result is written once, since the recursion's limit of
    rows is lifted only while it runs.  The only leaf of a table has no siblings and folds to itself.
    """
    spark = manifest.leaves.sparkSession
    leaves = cut(manifest.leaves)
    mine, others = "substring(children, 1, 32 * {p})", "substring(children, 32 * {p} + 33)"
    members = leaves.where("parent is not null").groupBy(F.col("parent").alias("run")).agg(F.collect_list(F.struct(*leaves.columns)).alias("members"))  # eight at most
    nodes = manifest.nodes
    started = members.join(nodes.withColumnRenamed("node", "run").withColumnsRenamed({"parent": "next", "pos": "next_pos"}), "run")
    fold = f"transform(members, m -> unhex(sha2(lower(hex(concat({mine.format(p='m.pos')}, m.`{shown}`, {others.format(p='m.pos')}))), 256)))"
    started = cut(started.selectExpr("run", "next as parent", "next_pos as pos", f"{fold} as folded", "members", "children"))
    limits = {k: spark.conf.get(k) for k in (_ROW_LIMIT, _LEVEL_LIMIT)}
    try:
        for k in limits:
            spark.conf.set(k, "-1")
        climbed = cut(spark.sql(_CLIMB, start=started.select("run", "parent", "pos", "folded"), nodes=nodes))
    finally:
        for k, v in limits.items():
            spark.conf.set(k, v)
    both = started.select("run", "members", "children").join(climbed, "run")
    rows = both.select("children", "siblings", F.explode(F.arrays_zip("members", "folded")).alias("m"))
    own = F.expr("concat(substring(children, 1, 32 * m.members.pos), substring(children, 32 * m.members.pos + 33), siblings)")
    found = rows.select("m.members.*", own.alias("proof"), F.col("m.folded").alias("folded"))
    lone = leaves.where("parent is null").select("*", F.lit(b"").cast("binary").alias("proof"), F.col(f"`{shown}`").alias("folded"))
    return found.unionByName(lone).drop("parent", "pos")
