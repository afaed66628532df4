"""Connected components by star contraction, as DataFrame joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import written


def _toward_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of each node u to the least of u and its neighbours.

    ``larger_only``: only neighbours above u are moved (large star), else those
    below (small star).  The least neighbour is a combined aggregation; the join
    back has one row per node on its side, so a hot node's links can be split.
    """
    both = edges if not larger_only else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # u = a; for the small star a > b already holds for every row.
    if not larger_only:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    moved = both.join(least, F.col("a") == F.col("u"))
    if larger_only:
        out = moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (moved.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
               .union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node of its component.

    Large and small stars alternate until nothing changes; each round is a
    written table.  Self links are ignored; an empty table gives an empty one.
    """
    now = written(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "component-links")
    before = None
    while True:
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == before:
            break
        before = tuple(sums)
        now = written(_toward_least(_toward_least(now, True), False), "component-links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
