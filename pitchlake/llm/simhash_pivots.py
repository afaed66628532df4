"""SimHash near-duplicates through pivot distance tables.

The pivot table, written once, has a row for each distinct fingerprint: its
Hamming distances to ``PIVOTS`` reference fingerprints, a byte each.  Two
fingerprints within distance d differ by at most d in each of these
coordinates, so a pair with a larger difference in any one is discarded, and
only survivors are compared bit by bit.

Pairs come together by equal bits: of ``SEGMENTS`` segments of a fingerprint at
most d differ, so some ``SEGMENTS - d`` agree, and one key per choice of those
segments loses no pair.  A bucket (rows of one key) gives the links of a
spanning forest, never all its pairs, so a bucket of m near copies emits fewer
than m rows.  Buckets above ``WIDE`` rows are dealt out again by choices of the
bits that their key leaves open and by cells of the first two coordinates: a row
goes to the cell of its coordinate and to that of the coordinate plus d, so two rows
whose coordinates differ by at most d meet in the cell of the larger one.  What
agrees then on 48 bits has at most 2^16 distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import written
from pitchlake.llm.components import components

SHINGLE, MAX_DISTANCE, SEED = 3, 3, 42
PIVOTS, SEGMENTS, WIDE = 16, 6, 2000
# Width of a cell of a coordinate, and the coordinates that have cells, in wide buckets.
CELL, CELLED = 8, 2


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles (A-Z lower-cased); no words: 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    whole = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    cuts = map(slice, starts[:n].tolist(), ends.tolist())
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(whole.__getitem__, cuts), repeat(SEED)), dtype="<u8", count=n)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp) for every row: fp is the fingerprint as a signed long.  Null texts have none of the words: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["key", "fp"])

    return docs.select(F.col(key).cast("long").alias("key"), text).mapInArrow(run, "key long, fp long")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: fixed pseudo-random numbers."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(n)], dtype=np.uint64)


def pivot_table(fps: DataFrame, n_pivots: int = PIVOTS) -> DataFrame:
    """(fp, near) for each row of ``fps``: near holds the distances to the pivots, a byte each, eight in a long."""

    def packed(refs: list[int]) -> Column:
        bytes_ = [F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(r))).cast("long"), 8 * i) for i, r in enumerate(refs)]
        return reduce(Column.bitwiseOR, bytes_)

    refs = pivots(n_pivots).view(np.int64).tolist()
    return fps.select("fp", F.array(*[packed(refs[i:i + 8]) for i in range(0, n_pivots, 8)]).alias("near"))


def coordinate(i: int) -> Column:
    """The distance to pivot ``i`` of a row of the pivot table."""
    return F.shiftright(F.col("near")[i // 8], 8 * (i % 8)).bitwiseAND(F.lit(255))


def segment_masks(segments: int = SEGMENTS, width: int = 64) -> list[int]:
    """Bit masks of ``segments`` segments that cover ``width`` bits."""
    edge = [round(i * width / segments) for i in range(segments + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edge, edge[1:])]


def choice_masks(max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS) -> list[int]:
    """A mask for each choice of segments that must agree in some pair within the distance."""
    return [sum(c) for c in combinations(segment_masks(segments), segments - max_distance)]


def finer_masks(mask: int, max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS) -> list[int]:
    """``mask`` with choices of segments of the bits that it leaves open (again one holds for every close pair)."""
    free = [i for i in range(64) if not mask >> i & 1]
    groups = [sum(1 << int(i) for i in g) for g in np.array_split(free, segments) if len(g)]
    keep = max(0, len(groups) - max_distance)
    return [mask | sum(c) for c in combinations(groups, keep)]


def bucket_rows(fps: DataFrame, masks: list[int]) -> DataFrame:
    """(table, part) beside the columns of ``fps``, for each mask: rows with equal ones agree on that mask's bits."""
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])
    return fps.select("*", F.posexplode(keys).alias("table", "part"))


def with_cells(rows: DataFrame, max_distance: int = MAX_DISTANCE, celled: int = CELLED, width: int = CELL) -> DataFrame:
    """``rows`` once for each cell: rows whose first coordinates differ by at most the distance share one (column cell)."""
    rows = rows.withColumn("cell", F.lit(0).cast("long"))
    for i in range(celled):
        both = F.array_distinct(F.array(*[F.floor((coordinate(i) + d) / width).cast("long") for d in (0, max_distance)]))
        rows = rows.select("*", F.explode(both).alias("own")).withColumn("cell", F.col("cell") * 256 + F.col("own")).drop("own")
    return rows


def forest(fps: np.ndarray, near: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a spanning forest of the rows within ``max_distance`` of each other, and counts of the work.

    ``near`` holds the rows' distances to the pivots.  Rows are compared in
    order of their first coordinate, only as far as it differs by at most the
    distance; the other coordinates discard most of the rest.  Counted are pairs
    of rows, those not discarded nor joined before, and links.
    """
    order = np.argsort(near[:, 0], kind="stable")
    f, r = fps[order], near[order].astype(np.int8)
    upto = np.searchsorted(r[:, 0], r[:, 0] + max_distance, side="right")
    found, joined, verified = [], 0, 0
    tree = np.arange(len(f))
    for i in range(len(f) - 1):
        j = np.arange(i + 1, upto[i])
        apart = tree[j] != tree[i]
        joined += len(j) - int(apart.sum())
        j = j[apart]
        for c in range(1, r.shape[1], 5):
            if not len(j):
                break
            j = j[(np.abs(r[j, c:c + 5] - r[i, c:c + 5]) <= max_distance).all(axis=1)]
        verified += len(j)
        j = j[np.bitwise_count(f[j] ^ f[i]) <= max_distance] if len(j) else j
        for t in np.unique(tree[j]):
            found.append((order[i], order[j[tree[j] == t][0]]))
            tree[tree == t] = tree[i]
    met = len(f) * (len(f) - 1) // 2
    return (np.array(found, dtype=np.int64).reshape(-1, 2),
            np.array([met, met - joined - verified, verified, len(found)], dtype=np.int64))


def linked(buckets: DataFrame, max_distance: int = MAX_DISTANCE, counts: bool = False) -> DataFrame:
    """Links (a, b) of a spanning forest of each bucket.

    ``buckets`` has (table, part, cell, fp, near), fp distinct in a bucket.
    ``counts``: not the links but, a row per Arrow batch, the pairs that met, that the
    coordinates discarded, that were verified bit by bit, and the links.
    """

    def links(f: np.ndarray, near: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of whole buckets in a row: pairs in buckets of two by one operation, the others by ``forest``."""
        two = starts[sizes == 2]
        close = (np.abs(near[two].astype(np.int8) - near[two + 1].astype(np.int8)) <= max_distance).all(axis=1)
        verified = two[close]
        two = verified[np.bitwise_count(f[verified] ^ f[verified + 1]) <= max_distance]
        out_a, out_b = [f[two]], [f[two + 1]]
        work = np.array([len(close), len(close) - len(verified), len(verified), len(two)], dtype=np.int64)
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            x = f[s:s + n]
            pairs, of_bucket = forest(x, near[s:s + n], max_distance)
            out_a.append(x[pairs[:, 0]])
            out_b.append(x[pairs[:, 1]])
            work += of_bucket
        return np.concatenate(out_a), np.concatenate(out_b), work

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last bucket so far, which may go on
        for batch in (*batches, None):
            if batch is not None and not batch.num_rows:
                continue
            if batch is not None:
                new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
                new.append(batch.column(4).flatten().to_numpy().view(np.uint8).reshape(batch.num_rows, -1))
                held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if held is None or not len(held[0]):
                continue
            t, p, c, f, near = held
            edge = np.flatnonzero((t[1:] != t[:-1]) | (p[1:] != p[:-1]) | (c[1:] != c[:-1])) + 1
            starts = np.concatenate(([0], edge))
            ends = np.concatenate((edge, [len(t)]))
            if batch is not None:
                held = [x[starts[-1]:] for x in held]
                starts, ends = starts[:-1], ends[:-1]
            a, b, work = links(f.view(np.uint64), near, starts, ends - starts)
            if counts:
                yield pa.RecordBatch.from_arrays([pa.array([int(n)]) for n in work], names=["met", "discarded", "verified", "links"])
            elif len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    dealt = buckets.select("table", "part", "cell", "fp", "near").repartition("table", "part", "cell")
    return dealt.sortWithinPartitions("table", "part", "cell").mapInArrow(
        run, "met long, discarded long, verified long, links long" if counts else "a long, b long")


def near_links(fps: DataFrame, max_distance: int = MAX_DISTANCE, counts: bool = False) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) within ``max_distance``, enough to connect all that are.

    ``counts``: the counts of ``linked`` instead; a pair counts once for each bucket in which it meets.
    """
    masks = choice_masks(max_distance)
    table = written(pivot_table(fps), "simhash-pivots")
    rows = bucket_rows(table.select("fp"), masks)
    several = rows.groupBy("table", "part").count().filter(F.col("count") > 1)
    sizes = written(several, "simhash-buckets")  # buckets of one row, by far the most, end here
    narrow = rows.join(sizes.filter(F.col("count") <= WIDE), ["table", "part"]).join(table, "fp")
    near = linked(narrow.withColumn("cell", F.lit(0).cast("long")), max_distance, counts)
    wide = sizes.filter(F.col("count") > WIDE)
    if wide.isEmpty():
        return near
    for t in [r["table"] for r in wide.select("table").distinct().collect()]:  # at most one per mask
        of_table = rows.filter(F.col("table") == t).join(wide.filter(F.col("table") == t), ["table", "part"])
        finer = bucket_rows(of_table.select("fp").join(table, "fp"), finer_masks(masks[t], max_distance))
        near = near.union(linked(with_cells(finer, max_distance), max_distance, counts))
    return near


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(key, fp, component) per row: component is the smallest non-null key whose fingerprint is reachable by links.

    Rows of one fingerprint are one node.  Empty, blank and null texts have
    fingerprint 0 and are linked like any others.  Repeated keys keep their
    rows; a component without a key gives null; an empty table gives no rows.
    """
    of_doc = written(fingerprints(docs, key, text, shingle), "simhash-fingerprints")
    nodes = written(of_doc.groupBy("fp").agg(F.min("key").alias("first")), "simhash-nodes")
    root_of = written(components(near_links(nodes.select("fp"), max_distance)), "simhash-components")
    labelled = nodes.join(root_of, nodes["fp"] == root_of["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = labelled.filter(F.col("root") != F.col("fp")).groupBy("root").agg(F.min("first").alias("least"))
    # Fingerprints without a link stand for themselves; the rest look up their component.
    named = (labelled.join(least.select(F.col("root").alias("r"), "least"), F.col("root") == F.col("r"), "left")
             .select(F.col("fp").alias("f"), "root", "first", "least"))
    root_first = nodes.select(F.col("fp").alias("rf"), F.col("first").alias("root_first"))
    named = (named.join(root_first, F.col("root") == F.col("rf"), "left")
             .select("f", F.least("least", "root_first").alias("component")))
    return (of_doc.join(named, F.col("fp") == F.col("f")).select("key", "fp", "component"))
