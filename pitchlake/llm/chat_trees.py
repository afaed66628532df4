"""Chat formatting of reply trees.

Messages form trees by (tree, node, parent).  ``branches`` enumerates every
root-to-leaf path by iterative self-joins that double the reach of an ancestor
table (log2 of the depth many), ``best`` ranks the branches of a tree by score,
and ``format_branches`` writes each chosen path as one conversation text with a
loss mask.  SQL functions only.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  In roles and texts
a backslash becomes ``\\s``, ``<|`` becomes ``\\b`` and, in roles, a line end
becomes ``\\n``; so control strings stand only where the template puts them,
and ``parse`` gives back every turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import written

START, END = "<|im_start|>", "<|im_end|>\n"
MESSAGE = ("tree", "node", "parent", "role", "text", "score")


def escape(x: Column, line_ends: bool = False) -> Column:
    x = F.replace(F.replace(x, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("\\b"))
    return F.replace(x, F.lit("\n"), F.lit("\\n")) if line_ends else x


def unescape(x: Column) -> Column:
    x = F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("<|"))
    return F.replace(x, F.lit("\\s"), F.lit("\\"))


def tidy(messages: DataFrame) -> DataFrame:
    """One message per (tree, node): columns of ``MESSAGE`` only.

    A message without a node id can't be placed and is left out.  Of rows that
    repeat a node the smallest (parent, role, text, score) stays.  A parent that
    is null, missing or the node itself makes the message a root.  Null roles and
    texts are empty, null scores 0.  A null tree is a tree like any other.
    """
    m = messages.filter(F.col("node").isNotNull()).select(
        "tree", "node", F.when(F.col("parent") != F.col("node"), F.col("parent")).alias("parent"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    once = m.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m")).select("tree", "node", "m.*")
    nodes = once.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    return (once.join(nodes, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n")), "left")
            .select("tree", "node", F.col("n").alias("parent"), "role", "text", "score"))


def branches(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): every node of every root-to-leaf path, ``up`` steps above its leaf.

    ``nodes`` has tree, node and parent (null: root), one row each.  Ancestor
    tables for 1, 2, 4, ... steps come from self-joins, each written to the
    shared folder; paths are then filled from the longest step down.  Rows grow
    as the paths themselves do.  A branch that never reaches a root (its replies
    form a cycle) is left out.
    """
    steps = [written(nodes.filter(F.col("parent").isNotNull()).select("tree", "node", F.col("parent").alias("above")), "reply-steps")]
    total = None
    while True:
        last = steps[-1]
        up = last.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("above").alias("a"))
        further = written(last.join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.col("above") == F.col("n")))
                          .select("tree", "node", F.col("a").alias("above")), "reply-steps")
        if further.isEmpty():
            cycles = None
            break
        steps.append(further)
        total = nodes.count() if total is None else total
        if 2 ** (len(steps) - 1) > total:  # deeper than there are nodes: these never end
            cycles = further.select("tree", F.col("node").alias("leaf"))
            break
    parents = steps[0].select(F.col("tree").alias("t"), F.col("above").alias("n")).distinct()
    paths = (nodes.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
             .select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")))
    if cycles is not None:
        c = cycles.select(F.col("tree").alias("t"), F.col("leaf").alias("l"))
        paths = paths.join(c, F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("l")), "left_anti")
    for k in range(len(steps) - 1, -1, -1):
        s = steps[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "above")
        more = paths.join(s, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select(
            "tree", "leaf", F.col("above").alias("node"), (F.col("up") + 2 ** k).alias("up"))
        paths = written(paths.union(more), "reply-paths") if k else paths.union(more)
    return paths


def best(paths: DataFrame, keep: int = 1, spread: int = 32) -> DataFrame:
    """The ``keep`` branches of each tree with the largest summed score: tree, leaf, score, rank.

    ``paths`` has tree, leaf, score per node.  Ties go to the smaller leaf.  Each
    tree is ranked in ``spread`` parts first, so a tree with very many branches
    sends at most ``keep * spread`` of them to one task.
    """
    scored = paths.groupBy("tree", "leaf").agg(F.sum("score").alias("score"))
    part = F.pmod(F.xxhash64("leaf"), F.lit(spread))
    order = [F.desc("score"), F.asc("leaf")]
    first = scored.withColumn("__part", part).withColumn("rank", F.row_number().over(
        Window.partitionBy("tree", "__part").orderBy(*order))).filter(F.col("rank") <= keep)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order))).filter(
        F.col("rank") <= keep).select("tree", "leaf", "score", "rank")


def format_branches(messages: DataFrame, keep: int = 1) -> DataFrame:
    """Each chosen branch as one conversation: tree, leaf, rank, score, n_turns, formatted, loss_spans.

    ``loss_spans`` are (first, length) in code points of ``formatted``: the text
    of every assistant turn, as it stands there.  An empty table gives no rows.
    """
    nodes = written(tidy(messages), "reply-nodes")
    places = written(branches(nodes.select("tree", "node", "parent")), "reply-branches")
    n = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text", "score")
    same = F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))
    chosen = best(places.join(n.select("t", "n", "score"), same).select("tree", "leaf", "score"), keep)
    c = chosen.select(F.col("tree").alias("t"), F.col("leaf").alias("l"), F.col("score").alias("branch_score"), "rank")
    turns = (places.join(c, F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("l"))).drop("t", "l")
             .join(n.drop("score"), same)
             .select("tree", "leaf", "rank", "branch_score", F.struct(
                 (-F.col("up")).alias("at"), F.concat(F.lit(START), escape(F.col("role"), True), F.lit("\n")).alias("head"),
                 escape(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("loss")).alias("turn")))
    whole = turns.groupBy("tree", "leaf").agg(F.min("rank").alias("rank"), F.min("branch_score").alias("score"),
                                              F.sort_array(F.collect_list("turn")).alias("turns"))
    lengths = F.transform("turns", lambda t: (F.length(t["head"]) + F.length(t["body"]) + len(END)).cast("long"))
    ends = F.aggregate("lengths", F.array().cast("array<bigint>"), lambda acc, x: F.array_append(
        acc, x + F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0).cast("long"))))
    return (whole.withColumn("lengths", lengths).withColumn("ends", ends)
            .select("tree", "leaf", "rank", "score", F.size("turns").cast("long").alias("n_turns"),
                    F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
                    F.filter(F.transform("turns", lambda t, i: F.when(t["loss"], F.struct(
                        (F.get("ends", i) - len(END) - F.length(t["body"])).alias("first"),
                        F.length(t["body"]).cast("long").alias("length")))), lambda x: x.isNotNull()).alias("loss_spans")))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    turns = F.split(formatted, "<\\|im_end\\|>\n")
    return F.transform(F.slice(turns, 1, F.size(turns) - 1), lambda t: F.struct(
        unescape(F.substr(F.substring_index(t, "\n", 1), F.lit(len(START) + 1))).alias("role"),
        unescape(F.substr(t, F.locate("\n", t) + 1)).alias("text")))


def masked(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(
        formatted, (s["first"] + 1).cast("int"), s["length"].cast("int")))), "")
