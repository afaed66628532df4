"""Sequence number of each row inside its group (``row_number``), whatever the size of the group.

One plan for all groups, in which every number follows from column values:

1. groups with more than ``rows_per_bucket`` rows get bounds, quantiles of
   their first order column, and the number of rows before each of them.  Both are
   written once (one row per such group), so a recomputed task sees the same ones;
2. a row's bucket is the number of bounds of its group below its order value,
   0 without bounds, so buckets of a group follow each other in order;
3. rows are numbered inside (group, bucket), and the rows of earlier buckets are
   added.

The wide rows are joined once, with the small written table, and shuffled once, by
(group, bucket); without groups above ``rows_per_bucket`` the join falls away.
Poor bounds cost balance, never a number.  Rows that tie on the first order
column share a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.session import scratch_path

# Rows of a group that one task sorts.
DEFAULT_ROWS_PER_BUCKET = 1_000_000
# Most buckets of a group (the resolution of its bounds).
MAX_BUCKETS = 1000


def windowed_index(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], out: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY … ORDER BY …)`` as an int column."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(out, F.row_number().over(w).cast("int"))


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality of two lists of columns."""
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucket(order: Column) -> Column:
    """The number of bounds below the order value; 0 for NULL.  A binary search: ten steps a row, however many bounds."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(MAX_BUCKETS.bit_length()))])
    below = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get("__bounds", n + step - 1) < order, n + step).otherwise(n))
    return F.when(F.col("__bounds").isNull() | order.isNull(), 0).otherwise(below)


def deal(df: DataFrame, near: str, value: Column, spread_on: Sequence[str]) -> Column:
    """A number never NULL to repartition by: rows of a ``value`` of column ``near`` get a few of them, by their ``spread_on``.

    There are about four numbers per shuffle partition, so that a task writes into few partitions of a table and none gets most rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, -(-4 * parts // max(1, df.select(near).distinct().count())))
    return F.xxhash64(value, F.pmod(F.xxhash64(*spread_on), F.lit(salts)))


def group_bounds(df: DataFrame, keys: Sequence[str], order: str, rows_per_bucket: int,
                 sizes_from: DataFrame | None = None) -> DataFrame:
    """(``__k0``…, ``__bounds``, ``__before``) of every group above ``rows_per_bucket`` rows, written.

    ``__bounds`` are ascending; ``__before`` has the number of rows in earlier buckets, for each bucket from 0.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    counted = (sizes_from if sizes_from is not None else df).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    large = _kept(counted.filter(F.col("__rows") > rows_per_bucket)
                  .select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__rows"), "sequence-groups")
    value = F.percentile_approx(F.col(order), F.array(*[F.lit(i / MAX_BUCKETS) for i in range(1, MAX_BUCKETS)]), F.lit(10_000))
    # Every (MAX_BUCKETS / buckets)-th quantile.
    buckets = F.least(F.lit(MAX_BUCKETS), F.ceil(F.col("__rows") / rows_per_bucket)).cast("int")
    narrow = df.select(*keys, F.col(order).alias("__order"))
    quantiles = (df.select(*keys, order).join(large, _same(keys, names)).groupBy(*names).agg(
        value.alias("__q"), F.first("__rows").alias("__rows")))
    chosen = F.array_distinct(F.transform(F.sequence(F.lit(1), buckets - 1), lambda i: F.element_at(
        "__q", F.greatest(F.lit(1), F.floor(i * MAX_BUCKETS / buckets).cast("int")))))
    bounds = quantiles.select(*names, chosen.alias("__bounds"))
    if large.isEmpty():
        return bounds.withColumn("__before", F.array().cast("array<bigint>")).limit(0)  # no rows: joins with it fall away
    bounds = _kept(bounds, "sequence-bounds")
    # At most MAX_BUCKETS rows per group.
    sizes = (narrow.join(bounds, _same(keys, names)).groupBy(*names, _bucket(F.col("__order")).alias("__bucket"))
             .agg(F.count(F.lit(1)).alias("__n")).groupBy(*names).agg(F.collect_list(F.struct("__bucket", "__n")).alias("__sizes"))
             .select(*[F.col(n).alias(f"{n}_of") for n in names], "__sizes"))
    before = F.transform(F.sequence(F.lit(0), F.size("__bounds")), lambda i: F.aggregate(
        F.filter("__sizes", lambda e: e["__bucket"] < i), F.lit(0).cast("long"), lambda n, e: n + e["__n"]))
    return _kept(bounds.join(sizes, _same(names, [f"{n}_of" for n in names])).select(*names, "__bounds", before.alias("__before")),
                 "sequence-buckets")


def sequence_index(df: DataFrame, partition_by: Sequence[str] = ("game_pk",),
                   order_by: Sequence[str] = ("at_bat_number", "pitch_number"), out: str = "idx_game_pitch",
                   rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, sizes_from: DataFrame | None = None,
                   near: str | None = None) -> DataFrame:
    """Number the rows of each group 1..n in order (``row_number``, NULLs first, NULL keys a group).

    The first order column must be a number, a date or a timestamp.
    ``sizes_from`` may give a cheaper frame to count the groups on: any frame
    holding the key columns for a superset of ``df``'s rows.  Counts only
    decide how many buckets a group gets.  ``near`` names a column that seldom differs
    inside a group: rows are dealt by it too, so that the one shuffle also serves a
    write partitioned by it.
    """
    keys, order = list(partition_by), list(order_by)
    names = [f"__k{i}" for i in range(len(keys))]
    bounds = group_bounds(df, keys, order[0], rows_per_bucket, sizes_from)
    rows, dealt = df, []
    if near is not None:
        value = F.col(near)
        spread = _kept(df.groupBy(*keys).agg(F.min(near).alias("__home"), F.max(near).alias("__last"), F.count(near).alias("__set"),
                                             F.count(F.lit(1)).alias("__all"))
                       .filter((F.col("__home") != F.col("__last")) | ((F.col("__set") > 0) & (F.col("__set") < F.col("__all"))))
                       .select(*[F.col(k).alias(f"__s{i}") for i, k in enumerate(keys)], "__home"), "sequence-spread")
        if not spread.isEmpty():  # groups of several values are dealt by their least one
            rows = df.join(spread, _same(keys, [f"__s{i}" for i in range(len(keys))]), "left")
            value = F.coalesce("__home", near)
        rows, dealt = rows.withColumn("__deal", deal(df, near, value, keys)), ["__deal"]
    inside = Window.partitionBy(*dealt, *keys, "__bucket").orderBy(*order)
    rows = rows.join(bounds, _same(keys, names), "left").withColumn("__bucket", _bucket(F.col(order[0])))
    if dealt:
        rows = rows.withColumn("__deal", F.xxhash64("__deal", "__bucket")).repartition("__deal")
    return (rows.withColumn("__earlier", F.coalesce(F.get("__before", F.col("__bucket")), F.lit(0).cast("long")))
            .withColumn(out, (F.row_number().over(inside) + F.col("__earlier")).cast("int"))
            .select(*df.columns, out))
