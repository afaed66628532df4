"""Ranked lexical search: exact inner products through sparse ball trees.

1. The terms of the items (the queries) make a vocabulary; one pass over the
   documents keeps, per document, the number of its terms and its counts of
   vocabulary terms.  Other terms add nothing to any score.  A vocabulary has at
   most ``BLOCK_TERMS`` terms of all items together, as it goes to every task;
   more items are dealt into blocks, each a pass of its own.
2. Weights follow from the written counts (N, L and document frequencies).
3. Every task cuts its documents into ball trees of bounded size.  A document is
   the sparse vector of its integer term values; a node has the centroid of its
   documents and a radius that, rounded up, no document exceeds.
4. A query's score in a node is at most <q, centroid> + |q| * radius, rounded up;
   the radius is also kept by column, so that only the part of it that lies in
   the query's columns counts.  Subtrees are opened best first and dropped once this bound is below the
   query's k-th best score so far, which a task carries from tree to tree.
   Leaves are scored in 64-bit integers; a tie is never dropped.
5. The k best per query of every task meet in parts, then as one list.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import discard, written

# Terms of the items of a block; documents and entries of a tree; documents of a leaf.
BLOCK_TERMS, TREE_DOCS, TREE_ENTRIES, LEAF = 1 << 20, 1 << 14, 1 << 21, 48
# Parts in which the lists of the tasks meet first.
PARTS = 64

# Bytes that are in terms: 0-9, A-Z as a-z, a-z and all beyond ASCII; the others part terms.
_TERM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class BallTree:
    """Documents as rows of (column, positive integer value); finds the highest inner products with queries."""

    def __init__(self, indptr: np.ndarray, cols: np.ndarray, vals: np.ndarray, width: int, leaf: int = LEAF):
        self.width, self.leaf = width, leaf
        self.order: list[np.ndarray] = []  # per leaf: the rows, and their entries
        self.nodes: list[tuple] = []  # centroid columns, centroid, radius by column, radius, rounding, children or leaf
        self.scratch = np.zeros(width)
        self.leaves_scored = 0
        if len(indptr) > 1:
            self._add(np.arange(len(indptr) - 1), np.diff(indptr), cols, vals)

    def _add(self, rows: np.ndarray, sizes: np.ndarray, cols: np.ndarray, vals: np.ndarray) -> int:
        n, me = len(rows), len(self.nodes)
        of = np.repeat(np.arange(n), sizes)
        x = vals.astype(np.float64)
        used, place = np.unique(cols, return_inverse=True)
        centre = np.bincount(place, weights=x, minlength=len(used)) / n
        norms = np.bincount(of, weights=x * x, minlength=n)
        own = float(centre @ centre)
        # Each sum of m terms is off by at most m rounding steps of the sum of its sizes.
        slack = (len(x) + len(used) + 16) * 2.3e-16
        square = norms - 2 * np.bincount(of, weights=x * centre[place], minlength=n) + own
        radius = math.sqrt(max(float(square.max()), 0.0) + 4 * slack * (float(norms.max()) + own)) * (1 + 1e-12)
        # The radius along each column: no document is further from the centroid there (its value, or none at all).
        along = np.zeros(len(used))
        np.maximum.at(along, place, np.abs(x - centre[place]))
        along = np.where(np.bincount(place, minlength=len(used)) < n, np.maximum(along, centre), along) * (1 + 4 * slack)
        self.nodes.append(())
        if n <= self.leaf:
            ends = np.cumsum(sizes)
            self.order.append((rows, ends - sizes, ends, cols, vals))
            below: tuple = (len(self.order) - 1,)
        else:
            # Along the line between the farthest document and the one farthest from it, cut in half.
            a = int(square.argmax())
            to_a = self._dots(of, place, x, a, n, len(used))
            b = int((norms - 2 * to_a + norms[a]).argmax())
            side = to_a - self._dots(of, place, x, b, n, len(used))
            upper = np.zeros(n, dtype=bool)
            upper[np.argsort(side, kind="stable")[n // 2:]] = True
            below = ()
            for half in (upper, ~upper):
                inside = half[of]
                below += (self._add(rows[half], sizes[half], cols[inside], vals[inside]),)
        self.nodes[me] = (used, centre, along, radius, slack, below)
        return me

    @staticmethod
    def _dots(of: np.ndarray, place: np.ndarray, x: np.ndarray, row: int, n: int, width: int) -> np.ndarray:
        dense = np.zeros(width)
        mine = of == row
        dense[place[mine]] = x[mine]
        return np.bincount(of, weights=x * dense[place], minlength=n)

    def search(self, columns: np.ndarray, factors: np.ndarray, k: int, best: list, key) -> list:  # noqa: ANN001
        """``best`` (a heap of (score, order) of at most k) with the rows of this tree; ``key(row)`` gives the order: higher is better."""
        if not self.nodes or not len(columns):
            return best
        dense, length = self.scratch, math.sqrt(float((factors * factors).sum())) * (1 + 1e-12)
        dense[columns] = factors
        whole = np.zeros(0)

        def bound(i: int) -> float:
            used, centre, along, radius, slack, _ = self.nodes[i]
            q = dense[used]
            hit = np.flatnonzero(q)
            q, near = q[hit], along[hit]
            # The part of the radius that the query can see, as a length and column by column: the least holds.
            reach = min(length * radius, length * math.sqrt(float(near @ near)) * (1 + 4 * slack), float(q @ near))
            return (float(q @ centre[hit]) + reach) * (1 + 4 * slack) + 1

        queue = [(-bound(0), 0)]
        while queue:
            most, i = heapq.heappop(queue)
            if len(best) == k and -most < best[0][0]:
                break
            below = self.nodes[i][5]
            if len(below) == 2:
                for child in below:
                    limit = bound(child)
                    if len(best) < k or limit >= best[0][0]:
                        heapq.heappush(queue, (-limit, child))
                continue
            self.leaves_scored += 1
            rows, starts, ends, cols, vals = self.order[below[0]]
            if not len(whole):
                whole = np.zeros(self.width, dtype=np.int64)
                whole[columns] = factors
            sums = np.concatenate(([0], np.cumsum(vals * whole[cols])))
            scores = sums[ends] - sums[starts]
            least = best[0][0] if len(best) == k else 1
            for at in np.flatnonzero(scores >= max(least, 1)).tolist():
                entry = (int(scores[at]), key(int(rows[at])))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        dense[columns] = 0
        return best


def _counted(docs: DataFrame, key: str, text: str, vocabulary) -> DataFrame:  # noqa: ANN001
    """(key, n, columns, counts) of every document: its number of terms and its counts of vocabulary terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            sizes, columns, counts = [], [], []
            for t in batch.column(1):
                found = terms(t.as_py())
                seen = Counter(found)
                held = sorted((known[x], seen[x]) for x in (seen.keys() & known.keys()))
                sizes.append(len(found))
                columns.append([c for c, _ in held])
                counts.append([n for _, n in held])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(columns, pa.list_(pa.int32())),
                                              pa.array(counts, pa.list_(pa.int64()))], names=["key", "n", "columns", "counts"])

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, "key long, n long, columns array<int>, counts array<long>")


def _searched(counted: DataFrame, known, k: int) -> DataFrame:  # noqa: ANN001
    """(query, key, score): the k best of every task for every query of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, n_terms, n_docs, queries = known.value
        best: list[list] = [[] for _ in queries]
        keys, sizes, cols, vals, held = [], [], [], [], 0

        def search() -> None:
            nonlocal keys, sizes, cols, vals, held
            own = [x for c in keys for x in c]
            tree = BallTree(np.concatenate(([0], np.cumsum(np.concatenate(sizes)))), np.concatenate(cols), np.concatenate(vals), len(weights))
            for q, (columns, factors) in enumerate(queries):
                # Equal scores: the smaller key is better, no key is last.
                tree.search(columns, factors, k, best[q], lambda r: (own[r] is not None, -(own[r] or 0)))
            keys, sizes, cols, vals, held = [], [], [], [], 0

        for batch in batches:
            n = batch.column(1).to_numpy()
            c, tf = batch.column(2), batch.column(3)
            size = np.diff(c.offsets.to_numpy())
            col, count = c.flatten().to_numpy(), tf.flatten().to_numpy()
            if n_terms:
                # By n * N div L in Python integers, which don't overflow.
                m = np.array([100 - 75 + 75 * int(x) * n_docs // n_terms for x in n], dtype=np.int64)
                value = weights[col] * ((1_000_000_000 * count) // (1000 * count + 8 * np.repeat(m, size)))
            else:
                value = np.zeros(0, dtype=np.int64)
            keys.append(batch.column(0).to_pylist())
            sizes.append(size)
            cols.append(col)
            vals.append(value)
            held += len(col)
            if sum(map(len, keys)) >= TREE_DOCS or held >= TREE_ENTRIES:
                search()
        if keys:
            search()
        rows = [(q, -e[1][1] if e[1][0] else None, e[0]) for q, found in enumerate(best) for e in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                                         names=["query", "key", "score"])

    return counted.mapInArrow(run, "query int, key long, score long")


def _blocks(items: DataFrame, item: str, text: str) -> tuple[DataFrame, int]:
    """The items with their terms counted, written, and dealt into blocks by a hash; the number of blocks.

    Blocks are made smaller until none has over ``BLOCK_TERMS`` terms or each such block is one item.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [Counter(terms(t.as_py())) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([list(s) for s in seen], pa.list_(pa.binary())),
                                              pa.array([list(s.values()) for s in seen], pa.list_(pa.int64()))], names=["row", "item", "terms", "counts"])

    rows = items.select(F.monotonically_increasing_id().alias("row"), F.col(item).cast("long").alias("item"), F.col(text).alias("text"))
    # Items without terms find nothing.
    table = written(rows.mapInArrow(run, "row long, item long, terms array<binary>, counts array<long>").filter(F.size("terms") > 0), "ball-items")
    n = 1
    while True:
        block = F.pmod(F.xxhash64("row"), F.lit(n))
        sizes = table.groupBy(block.alias("b")).agg(F.sum(F.size("terms")).alias("t"), F.count(F.lit(1)).alias("rows"))
        if not sizes.filter((F.col("t") > BLOCK_TERMS) & (F.col("rows") > 1)).limit(1).count():
            return table.withColumn("block", block), n
        n *= 2


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, rank, key, score): the ``k`` highest-scoring documents of every item, scores above 0.

    Terms are runs of ASCII letters and digits and characters beyond ASCII, A-Z
    lower-cased; null has none, and a document or item without terms finds and
    scores nothing.  Equal scores come by ascending key, documents without a key
    last.  Rows that repeat a key are documents of their own; rows that repeat an
    item are queries of their own, each with its own ranks.  Texts are taken
    whole; other columns are not read; empty tables give no rows.
    """
    spark = docs.sparkSession
    dealt, n = _blocks(items, item, text)
    found = None
    for b in range(n):
        # At most BLOCK_TERMS terms, or one item.
        rows = dealt.filter(F.col("block") == b).select("row", "item", "terms", "counts").collect()
        words = {bytes(t): i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r["terms"]}))}
        vocabulary = spark.sparkContext.broadcast(words)
        counted = written(_counted(docs, key, text, vocabulary), "ball-counts")
        n_docs, n_terms = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(words), dtype=np.int64)
        for c, df in counted.select(F.explode("columns").alias("c")).groupBy("c").count().collect():  # the vocabulary's terms at most
            weights[c] = weight(n_docs, df)
        queries = [(np.array([words[bytes(t)] for t in r["terms"]], dtype=np.int64), np.array(r["counts"], dtype=np.int64)) for r in rows]
        known = spark.sparkContext.broadcast((weights, n_terms, n_docs, queries))
        places = spark.createDataFrame([(i, r["row"], r["item"]) for i, r in enumerate(rows)], "query int, row long, item long")
        best = written(_searched(counted, known, k).withColumn("part", F.spark_partition_id() % PARTS), "ball-best")
        block = best.join(F.broadcast(places), "query").select("row", "item", "key", "score", "part")
        found = block if found is None else found.unionAll(block)
        discard(counted)
        vocabulary.unpersist()
        known.unpersist()
    by_score = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    for group in (["row", "part"], ["row"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*by_score))).filter(F.col("rank") <= k)
    return found.select("item", "rank", "key", "score")
