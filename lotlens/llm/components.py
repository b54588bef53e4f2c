"""Connected components of an edge table by repeated hooking to the smallest neighbour and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotlens.runtime import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is one node of its component, the same for all of them.

    Each round sends a node to its smallest neighbour, doubles these pointers until they reach their roots, and replaces
    the ends of every edge by their roots, until no edge is left.  A chain of any length is gone in one round, a star in
    two.  No group is ever gathered: minima are pre-aggregated and the joins are plain equi-joins that AQE can split.
    Loops and nulls are ignored; no edges give no rows.
    """

    def apart(pairs: DataFrame, a: str, b: str) -> DataFrame:
        return cut(pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct())

    links = apart(edges.where(F.col(a) != F.col(b)), a, b)
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")), F.struct(F.col("b").alias("node"), F.col("a").alias("to")))
    labels = None
    while not links.isEmpty():
        step = links.select(F.inline(ends)).groupBy("node").agg(F.min("to").alias("to"))
        step = cut(step.select("node", F.least("node", "to").alias("to"), F.lit(True).alias("moved")))
        while not step.where("moved").isEmpty():  # pointers double in length, so this ends after the logarithm of the depth
            far = step.select(F.col("node").alias("mid"), F.col("to").alias("next"))
            ahead = step.join(far, F.col("to") == F.col("mid"))
            step = cut(ahead.select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")))
        step = step.drop("moved")
        if labels is None:
            labels = step.select("node", F.col("to").alias("root"))
        else:
            moved = step.select(F.col("node").alias("root"), "to")
            labels = labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        labels = cut(labels)
        for end in ("a", "b"):
            links = links.join(step.select(F.col("node").alias(end), "to"), end).drop(end).withColumnRenamed("to", end)
        links = apart(links, "a", "b")
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
