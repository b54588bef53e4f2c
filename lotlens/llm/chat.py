"""Chat formatting of reply trees.

Messages point to the message they answer.  Repeated self-joins that double the step length give every message its
depth and the score of its path from the root; the best leaves of each tree are chosen, their paths are listed with the
same jump tables, and each path becomes one formatted conversation with a loss mask.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotlens.runtime import cut

END = "<|end|>\n"
_TURN = re.compile(r"<\|(.*?)\|>(.*?)<\|end\|>\n", re.S)


def escape(text: str) -> str:
    """text without control strings of this template and of other common ones.

    A backslash goes after their first character; where some stand there already they become one more, so nothing is lost.
    """
    text = re.sub(r"<(\\*)(\||/?s>)", r"<\\\1\2", text)
    return re.sub(r"\[(\\*)(/?INST\])", r"[\\\1\2", text)


def unescape(text: str) -> str:
    text = re.sub(r"<\\(\\*)(\||/?s>)", r"<\1\2", text)
    return re.sub(r"\[\\(\\*)(/?INST\])", r"[\1\2", text)


def format_turns(turns: list[tuple[str | None, str | None]], trained: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """(formatted conversation, spans of code points that carry loss: the texts of the trained role)."""
    out, spans, at = [], [], 0
    for role, text in turns:
        mark = f"<|{re.sub(r'\|(\\*)>', r'|\\\1>', escape(role or ''))}|>"
        body = escape(text or "")
        if role == trained:
            spans.append((at + len(mark), at + len(mark) + len(body)))
        out += [mark, body, END]
        at += len(mark) + len(body) + len(END)
    return "".join(out), spans


def read_back(formatted: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[str, str]], list[str]]:
    """(turns, texts under the loss mask), both unescaped."""
    turns = [(unescape(re.sub(r"\|\\(\\*)>", r"|\1>", role)), unescape(text)) for role, text in _TURN.findall(formatted)]
    return turns, [unescape(formatted[a:b]) for a, b in spans]


def _same(a: DataFrame, b: DataFrame, *on: tuple[str, str]):
    out = F.lit(True)
    for x, y in on:
        out = out & a[x].eqNullSafe(b[y])
    return out


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, path_score, node, step) of the best ``branches`` root-to-leaf paths of each tree.

    messages: tree, node, parent, score.  step counts from the leaf.  A path's score is the mean of its messages' scores,
    null counting 0; equal scores go to the smaller leaf.  A message whose parent is null, itself or not there is a root.
    Messages that lead into a loop have no root and lie on no path.  Of rows with equal (tree, node) one with the
    smallest (parent, score) counts.
    """
    first = messages.groupBy("tree", "node").agg(F.min(F.struct("parent", "score")).alias("m"))
    nodes = cut(first.select("tree", "node", F.col("m.parent").alias("parent"), F.coalesce(F.col("m.score").cast("double"), F.lit(0.0)).alias("score")))
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    jump = nodes.join(known, _same(nodes, known, ("tree", "t")) & (nodes["parent"] == known["n"]) & (nodes["node"] != nodes["parent"]), "left")
    jump = cut(jump.select("tree", "node", F.col("n").alias("up"), "score", F.lit(1).cast("long").alias("size")))
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    levels = []
    for _ in range(max(1, int(most).bit_length())):
        open_ = jump.where("up is not null")  # only what has not reached its root takes the next, longer step
        levels.append(open_.select("tree", "node", "up"))
        if open_.isEmpty():
            break
        far = jump.select(*[F.col(c).alias(f"_{c}") for c in jump.columns])
        both = open_.join(far, _same(open_, far, ("tree", "_tree")) & (open_["up"] == far["_node"]))
        moved = both.select("tree", "node", F.col("_up").alias("up"), (F.col("score") + F.col("_score")).alias("score"), (F.col("size") + F.col("_size")).alias("size"))
        jump = cut(jump.where("up is null").unionByName(moved))
    rooted = jump.where("up is null")  # what still has an ancestor after these steps runs in a loop
    answered = nodes.where("parent is not null and parent <> node").select(F.col("tree").alias("t"), F.col("parent").alias("n")).distinct()
    leaves = rooted.join(answered, _same(rooted, answered, ("tree", "t")) & (rooted["node"] == answered["n"]), "left_anti")
    ranked = leaves.withColumn("path_score", F.col("score") / F.col("size"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("path_score"), "node"))).where(F.col("rank") <= branches)
    paths = cut(ranked.select("tree", F.col("node").alias("leaf"), "rank", "path_score", "node", F.lit(0).cast("long").alias("step")))
    for k in reversed(range(len(levels))):
        far = levels[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        more = paths.join(far, _same(paths, far, ("tree", "t")) & (paths["node"] == far["n"]))
        more = more.select("tree", "leaf", "rank", "path_score", F.col("up").alias("node"), (F.col("step") + (1 << k)).alias("step"))
        paths = cut(paths.unionByName(more))
    return paths


_FORMATTED = "struct<formatted string, loss array<struct<start long, end long>>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def conversations(messages: DataFrame, branches: int = 1, trained: str = "assistant") -> DataFrame:
    """(tree, leaf, rank, path_score, formatted, loss) for the chosen paths of each tree.

    messages: tree, node, parent, role, text, score.  Null roles and texts are empty.  Texts are escaped reversibly; loss
    lists the code-point spans of the trained role's texts, in order.  See best_paths for ties, repeated rows, lost
    parents and loops; other columns are not read, and an empty table gives no rows.
    """
    paths = best_paths(messages.select("tree", "node", "parent", "score"), branches)
    said = messages.groupBy("tree", "node").agg(F.min(F.struct("parent", "score", "role", "text")).alias("m"))
    said = said.select(F.col("tree").alias("t"), F.col("node").alias("n"), "m.role", "m.text")
    turns = paths.join(said, _same(paths, said, ("tree", "t")) & (paths["node"] == said["n"]))
    turns = turns.groupBy("tree", "leaf", "rank", "path_score").agg(F.sort_array(F.collect_list(F.struct((-F.col("step")).alias("at"), "role", "text"))).alias("turns"))

    @F.arrow_udf(_FORMATTED)
    def formatted(turns: pa.Array) -> pa.Array:
        rows = []
        for path in turns.to_pylist():
            text, spans = format_turns([(t["role"], t["text"]) for t in path], trained)
            rows.append({"formatted": text, "loss": [{"start": a, "end": b} for a, b in spans]})
        return pa.array(rows, pa.struct([("formatted", pa.string()), ("loss", pa.list_(_SPAN))]))

    out = turns.withColumn("f", formatted("turns"))
    return out.select("tree", "leaf", "rank", "path_score", "f.formatted", "f.loss")


def as_tree(table: DataFrame, conv_id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages of a flat table of conversations: each row answers the one before it in (turn, role, text) order."""
    at = Window.partitionBy(conv_id).orderBy(turn, "role", "text")
    rows = table.withColumn("node", F.row_number().over(at).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select(F.col(conv_id).alias("tree"), "node", parent.alias("parent"), "role", "text", F.lit(None).cast("double").alias("score"))
