"""What filters do to each other: every order of them, audited through failing-id relations.

1. One pass over the texts writes a narrow table of all rows (row, part, labels)
   and, per filter, a table of the ids of the rows that fail it.
2. Sets of filters are walked level by level.  A level holds the survivors of
   every set of so many filters, as (set, row): per filter f outside a set, a
   left-semi join with the table of f gives what f removes after the set, and a
   left-anti join the survivors of the next larger set.  Orders that begin with
   the same filters share these rows, as a prefix's survivors don't depend on its
   order.  Rows that fail no filter survive every set and are only counted.
3. The counts of removals by (set, f, part), a few rows, give all orders: what
   is kept after a step, what a filter no longer finds, the sum over all orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations, permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import discard, written

FILTERS = "ABCDE"
_UPPER = bytes(b for b in range(256) if not 0x41 <= b <= 0x5A)
_SIGNS = frozenset(b"#$%&*|")


def text_failures(data: bytes) -> str:
    """The filters A to D that a text fails, as a string."""
    words = data.split()  # ASCII white space
    chars = len(data) if data.isascii() else len(data.decode("utf-8", "surrogatepass"))
    upper = len(data.translate(None, _UPPER))
    return "".join(name for name, fails in (
        ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)), ("C", 100 * upper > 3 * chars),
        ("D", not _SIGNS.isdisjoint(data))) if fails)


def measured(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """(row, key, part, fails, digest) of every row: its filters A to D and a 256-bit digest of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fails, digests = [], []
            for t in batch.column(3):
                data = (t.as_py() or "").encode("utf-8", "surrogatepass")
                fails.append(text_failures(data))
                digests.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fails, pa.string()), pa.array(digests, pa.binary())],
                                             names=["row", "key", "part", "fails", "digest"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"),
                       F.coalesce(F.col(part), F.lit("")).alias("part"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "row long, key long, part string, fails string, digest binary")


def repeated(rows: DataFrame) -> DataFrame:
    """(digest, first) of the texts that rows with different keys have: a row per text, combined before the shuffle."""
    return (rows.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last")).filter("first < last")
            .select("digest", "first"))


def copies(rows: DataFrame, first: DataFrame) -> DataFrame:
    """Rows whose text a row with a smaller key has too.  ``first`` is a written table, so that Spark may split a large group of copies."""
    return rows.join(first, "digest").filter(F.col("key") > F.col("first")).select("row")


def _sets(names: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for k in range(len(names) + 1) for s in combinations(names, k)]


def removed(level: DataFrame, failing: DataFrame, bit: int) -> DataFrame:
    """Rows of a level (``mask``: the set of filters passed) that the filter ``bit`` removes: a left-semi join with its ids."""
    return level.filter(F.col("mask").bitwiseAND(bit) == 0).join(failing, "row", "left_semi")


def survivors(level: DataFrame, failing: DataFrame, bit: int) -> DataFrame:
    """The survivors of each set of a level and the filter ``bit``: a left-anti join.  Sets grow by later filters only, so each comes once."""
    return level.filter(F.col("mask") < bit).join(failing, "row", "left_anti").withColumn("mask", F.col("mask").bitwiseOR(bit))


def removals(base: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """(part, counts): per part a map from "S>f" to the rows that f removes after the set S: all, good, toxic; "" holds the part's rows.

    ``base`` is (row, part, good, toxic), ``failing`` a written table of ids (row) per filter.
    """
    names = sorted(failing)
    sums = [F.count(F.lit(1)).alias("rows"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    found = [base.groupBy("part").agg(*sums).select(F.lit("").alias("step"), "part", "rows", "good", "toxic")]
    any_filter = reduce(DataFrame.unionAll, [failing[f] for f in names])
    level = written(base.join(any_filter, "row", "left_semi").withColumn("mask", F.lit(0)), "audit-level")
    for size in range(len(names)):
        gone = reduce(DataFrame.unionAll, [removed(level, failing[f], 1 << k).withColumn("f", F.lit(f)) for k, f in enumerate(names)])
        passed = F.concat(*[F.when(F.col("mask").bitwiseAND(1 << k) > 0, f).otherwise("") for k, f in enumerate(names)], F.lit(">"), F.col("f"))
        # A few rows: parts x filters x sets.
        found.append(written(gone.groupBy("mask", "f", "part").agg(*sums).select(passed.alias("step"), "part", "rows", "good", "toxic"), "audit-counts"))
        if size + 1 < len(names):
            larger = written(reduce(DataFrame.unionAll, [survivors(level, failing[f], 1 << k) for k, f in enumerate(names)]), "audit-level")
            discard(level)
            level = larger
    discard(level)
    rows = reduce(DataFrame.unionAll, found)
    return rows.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("step", F.struct("rows", "good", "toxic")))).alias("counts"))


def orders(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """A row per part, order of the filters and step, from the maps of ``removals``."""
    steps = []
    for order in permutations(names):
        for k, f in enumerate(order):
            before = "".join(sorted(order[:k]))
            alone = "".join(x for x in sorted(names) if x != f)
            steps.append(("".join(order), k + 1, f, before, alone))
    weight = {s: 0 for s in range(len(names))}
    for order in permutations(names):
        weight[order.index(names[0])] += 1  # orders with this many filters before a given one
    per_set = {k: n // len(list(combinations(range(len(names) - 1), k))) for k, n in weight.items()}

    def count(step, field: str = "rows"):  # noqa: ANN001, ANN202
        return F.coalesce(F.element_at("counts", step)[field], F.lit(0).cast("long"))

    total = {f: reduce(lambda a, b: a + b, [count(F.lit("".join(s) + ">" + f)) * per_set[len(s)] for s in _sets([x for x in names if x != f])])
             for f in names}
    listed = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).cast("int").alias("step"), F.lit(f).alias("f"), F.lit(f"{b}>{f}").alias("now"),
                                F.lit(f">{f}").alias("ever"), F.lit(f"{a}>{f}").alias("alone")) for o, k, f, b, a in steps])
    rows = (found.withColumn("totals", F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[total[f] for f in names])))
            .withColumn("s", F.explode(listed)).select("part", "counts", "totals", "s.*"))
    # What an order has removed by a step: its steps so far.
    so_far = reduce(lambda a, b: a + b, [
        F.when(F.col("step") >= k + 1, count(F.concat(F.array_join(F.array_sort(F.split(F.substring("filter_order", 1, k), "")), ""),
                                                      F.lit(">"), F.substring("filter_order", k + 1, 1)))).otherwise(F.lit(0).cast("long"))
        for k in range(len(names))])
    return rows.select(
        "part", "filter_order", "step", (count(F.lit("")) - so_far).alias("kept"), count(F.col("now")).alias("removed"),
        (count(F.col("ever")) - count(F.col("now"))).alias("redundant"), count(F.col("alone")).alias("unique_fails"),
        count(F.col("now"), "good").alias("good_lost"), count(F.col("now"), "toxic").alias("toxic_lost"),
        F.element_at("totals", F.col("f")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """A row per part, order of the five filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    Every row of ``docs`` counts, also rows that repeat a key or have none; a
    null text is empty (it fails A only, and E as a copy of an earlier empty one);
    a null part is the empty string; rows without a key are no copies and have no
    labels.  Rows of equal key and text are no copies of each other.  A document
    is good (toxic) if any row of ``labels`` says so.  Texts are taken whole; other
    columns are not read; an empty table gives no rows.
    """
    rows = written(measured(docs, key, text, part), "audit-rows")
    marks = (labels.groupBy(F.col(key).cast("long").alias("marked"))
             .agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")))
    # Rows without a key would all meet in one task of the join.
    named = rows.filter(F.col("key").isNotNull()).join(marks, F.col("key") == F.col("marked"), "left")
    zero = F.lit(0).cast("long")
    base = named.select("row", "part", F.coalesce("good", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic")).unionAll(
        rows.filter(F.col("key").isNull()).select("row", "part", zero.alias("good"), zero.alias("toxic")))
    base = written(base, "audit-base")
    failing = {f: written(rows.filter(F.col("fails").contains(f)).select("row"), f"audit-fails-{f}") for f in "ABCD"}
    first = written(repeated(rows), "audit-first")
    failing["E"] = written(copies(rows, first), "audit-fails-E")
    counts = written(removals(base, failing), "audit-removals")
    for table in (rows, base, first, *failing.values()):
        discard(table)
    return orders(counts, FILTERS)
