"""Chat formatting of reply trees.

Nodes (tree, node, parent, role, text, score) form trees. Self-joins follow the parents: each round doubles the
way that a node knows, so a path of n nodes takes log2(n) rounds, and ends when every node has reached a root.
Leaves give root-to-leaf paths; those of a tree are ranked by the sum of their scores, then length, then leaf,
and the best ``branches`` are formatted, each as one conversation.

A turn is written as ``### role``, a line end, the text and ``</turn>`` with a line end. Inside roles and texts
a backslash is doubled, ``### `` becomes ``\\s`` and ``</turn>`` becomes ``\\t`` (in roles a line end ``\\n``), so the
control strings occur nowhere else and reading back is exact.

A parent counts only if it comes before its child in ``node`` and is there; else the child is a root, so no
cycle is possible. Null texts and roles are empty, null scores 0. Null trees are one tree. Rows with a null node
are turns of their own. Of rows that repeat tree and node the least by all columns is used: nodes are unique by
definition (``chains`` numbers the turns of a table first, so there no row is lost). Empty tables give no rows.
Other columns are neither read nor returned. A conversation is one value of a row; everything before it is
spread over rows. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.common import settle

START, END = "### ", "</turn>"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit(START), F.lit("\\s")), F.lit(END), F.lit("\\t"))


def unescaped(text: Column) -> Column:
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), lambda part: F.replace(F.replace(F.replace(
        part, F.lit("\\s"), F.lit(START)), F.lit("\\t"), F.lit(END)), F.lit("\\n"), F.lit("\n"))), "\\")


def chains(rows: DataFrame, tree_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Turns in order as nodes, each the reply to the one before; ties are ordered by role and text."""
    rows = rows.select(F.col(tree_col).cast("long").alias("tree"), F.col(turn_col).alias("turn"),
                       F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    place = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    return rows.withColumn("node", place).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(nodes: DataFrame, branches: int) -> DataFrame:
    """(tree, leaf, node, back): the nodes of each tree's best root-to-leaf paths, ``back`` steps before the leaf.

    Level k of the jumps leads from a node to its 2^k-th ancestor; only nodes that have one are joined and
    kept in it. The same levels, from the highest down, then lead from each chosen leaf to all its ancestors.
    """
    def same(left: str, right: str) -> Column:
        return F.col("tree").eqNullSafe(F.col("t")) & (F.col(left) == F.col(right))

    up = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    known = nodes.select("tree", "node", "parent", "score").join(up, same("parent", "n") & (F.col("n") < F.col("node")), "left")
    state = settle(known.select("tree", "node", F.col("n").alias("up"), "score", F.lit(1).cast("long").alias("size")), "ways")
    parents = state.where("up is not null").select(F.col("tree").alias("t"), F.col("up").alias("n")).distinct()
    leaves = settle(state.select("tree", "node").join(parents, same("node", "n"), "left_anti").toDF("t", "n"), "leaves")
    levels = []
    while state.where("up is not null").limit(1).count():
        climbing = state.where("up is not null")
        levels.append(climbing.select(F.col("tree").alias("t"), F.col("node").alias("n"), "up"))
        above = state.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("further"),
                             F.col("score").alias("more"), F.col("size").alias("longer"))
        moved = climbing.join(above, same("up", "n")).select(
            "tree", "node", F.col("further").alias("up"), (F.col("score") + F.col("more")).alias("score"),
            (F.col("size") + F.col("longer")).alias("size"))
        state = settle(state.where("up is null").unionAll(moved), "ways")
    best = Window.partitionBy("tree").orderBy(F.col("score").desc(), F.col("size").desc(), "node")
    ended = state.join(leaves, same("node", "n"), "left_semi")
    chosen = ended.withColumn("place", F.row_number().over(best)).where(F.col("place") <= branches).select(
        "tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back"))
    for k, level in reversed(list(enumerate(levels))):
        jumped = chosen.join(level, same("node", "n")).select("tree", "leaf", F.col("up").alias("node"), F.col("back") + (1 << k))
        chosen = settle(chosen.unionAll(jumped), "paths")
    return chosen


def format_trees(nodes: DataFrame, branches: int = 1, learned_role: str = "assistant") -> DataFrame:
    """(tree, leaf, formatted, loss): a conversation per chosen path, with the spans [start, length] to learn.

    Spans count code points from 0 and cover the texts of ``learned_role``.
    """
    nodes = nodes.select(
        "tree", F.col("node").cast("long").alias("node"), F.col("parent").cast("long").alias("parent"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    loose = nodes.where("node is null")
    nodes = settle(nodes.where("node is not null").groupBy("tree", "node").agg(
        F.min(F.struct("parent", "role", "text", "score")).alias("r")).select("tree", "node", "r.*"), "nodes")
    steps = paths(nodes, branches).select("tree", "leaf", "node", (-F.col("back")).alias("place"))
    turns = steps.join(nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text"),
                       F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    turn = F.struct("place", F.lit(START).alias("a"), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n")).alias("role"),
                    escaped(F.col("text")).alias("text"))
    told = turns.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    alone = loose.select("tree", F.lit(None).cast("long").alias("leaf"), F.array(turn_of_loose()).alias("turns"))
    told = told.unionAll(alone)
    written = F.transform("turns", lambda t: F.concat(t["a"], t["role"], F.lit("\n"), t["text"], F.lit(f"{END}\n")))
    told = told.select("tree", "leaf", "turns", written.alias("written"))
    mark = F.replace(escaped(F.lit(learned_role)), F.lit("\n"), F.lit("\\n"))
    spans = F.aggregate(
        F.arrays_zip("turns", "written"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["written"])).alias("at"),
            F.when(t["turns"]["role"] == mark, F.concat(s["spans"], F.array(F.struct(
                (s["at"] + F.length(t["turns"]["role"]) + len(START) + 1).alias("start"), F.length(t["turns"]["text"]).alias("length"))))
                   ).otherwise(s["spans"]).alias("spans")),
        lambda s: s["spans"])
    return told.select("tree", "leaf", F.array_join("written", "").alias("formatted"), spans.alias("loss"))


def turn_of_loose() -> Column:
    return F.struct(F.lit(0).cast("long").alias("place"), F.lit(START).alias("a"),
                    F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n")).alias("role"), escaped(F.col("text")).alias("text"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.split(formatted, f"{END}\n", -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescaped(F.substr(F.substring_index(p, "\n", 1), F.lit(len(START) + 1))).alias("role"),
        unescaped(F.substr(p, F.instr(p, "\n") + 1)).alias("text")))


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss spans, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["length"]))), "")
