"""Removal of repeated 200-byte strings with suffix arrays.

Every 200-byte window has an anchor, the place of the least hash among its
16-byte grams (the rightmost of equals), so equal windows have equal anchors at equal
places.  Windows of one anchor, split by the half of the window that it stands
in, are a *context*: one byte range that holds them all, filed under a hash of
about 108 bytes that all of them share.  So

1. contexts are counted by that key; a key found once holds nothing repeated,
2. equal contexts of a key are one; all windows of one found twice repeat,
3. only keys with different contexts need their bytes.  Contexts are dealt by key
   to shards, each shard sorts its suffixes by Larsson-Sadakane refinement,
   Kasai's common prefixes show windows that repeat, and a key that spans shards
   is merged by binary search of one shard's windows in the other's suffix array.

A key with very many different contexts is dealt out again by narrower parts of the
window, whose keys share more bytes (in the end all 200, where contexts can't
differ), so no task gets an unbounded key.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from pitchlake.llm.common import byte_values, discard, mix, powers, prefix_hash, range_hash, release, text_chunks, written

WINDOW, GRAM = 200, 16
# Bytes of contexts in one suffix array, and different contexts of a key above which it is dealt out again.
SHARD_BYTES, WIDE = 1 << 19, 4000
# Windows that a merge of two shards holds as strings at once (200 bytes each, of either).
SLICE = 1 << 15
_SAME = bytes(range(256))
_POSITION = np.uint64((1 << 28) - 1)

RECORD = "key long, th long, lo int, n int, a int, p0 int, p1 int, part long, ctx long"


def part_hash(prefix: np.ndarray, a: np.ndarray, p0: np.ndarray, p1: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The key of windows whose anchor ``a`` stands p0..p1 bytes after their start: a hash of what all of them share."""
    shared = range_hash(prefix, a - p0, a - p1 + window)
    return mix(shared + (p0 * 1024 + p1).astype(np.uint64))


def context_hash(prefix: np.ndarray, lo: np.ndarray, n: np.ndarray, a: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A hash of a context: its bytes, length and the place of its anchor."""
    return mix(range_hash(prefix, lo, lo + n + window - 1) + (n * 4096 + a - lo).astype(np.uint64))


def contexts(texts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The contexts of all windows of some texts: text number, lo (in its text), n windows, anchor, part, hashes."""
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(size)
    data = b"".join(texts)
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < window:
        return dict.fromkeys(("of", "lo", "n", "a", "p0", "p1", "part", "ctx"), empty)
    prefix = prefix_hash(byte_values(data))
    count = len(data) - gram + 1
    _, down = powers(len(prefix))
    grams = mix((prefix[gram:] - prefix[:-gram]) * down[:count])
    least = (grams & ~_POSITION) | (_POSITION - np.arange(count, dtype=np.uint64))
    span, width = 1, window - gram + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    start = np.flatnonzero(np.arange(len(least)) + window <= np.repeat(ends, size)[:len(least)])
    if not len(start):
        return dict.fromkeys(("of", "lo", "n", "a", "p0", "p1", "part", "ctx"), empty)
    anchor = (_POSITION - (least[start] & _POSITION)).astype(np.int64)
    half = width // 2
    late = anchor - start > half
    new = np.ones(len(start), dtype=bool)
    new[1:] = (np.diff(start) != 1) | (np.diff(anchor) != 0) | (late[1:] != late[:-1])
    at = np.flatnonzero(new)
    lo, n, a = start[at], np.diff(np.append(at, len(start))), anchor[at]
    p0, p1 = np.where(late[at], half + 1, 0), np.where(late[at], width - 1, half)
    of = np.searchsorted(ends, lo, side="right")
    # A run can't cross texts: starts near a text's end are not valid.
    base = (ends - size)[of]
    return {"of": of, "lo": lo - base, "n": n, "a": a - base, "p0": p0, "p1": p1,
            "part": part_hash(prefix, a, p0, p1, window),
            "ctx": context_hash(prefix, lo, n, a, window)}


def refine(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Larsson-Sadakane refinement: suffix order of ``data`` by its first ``depth`` bytes, and each suffix's rank.

    Suffixes start sorted by eight bytes; each round sorts those that still tie by
    the rank of the suffix h bytes on and doubles h.  Ranks are the first place
    of a group of equals.  Bytes beyond the end count as smaller than any.
    """
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    first = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        first = (first << np.uint64(8)) | padded[k:n + k].astype(np.uint64)
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, dtype=np.int64)

    def group(places: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Set the ranks of the suffixes at ``places`` of the order (``new``: first of its group); return where ties remain."""
        starts = np.flatnonzero(new)
        length = np.diff(np.append(starts, len(places)))
        rank[order[places]] = np.repeat(places[starts], length)
        return places[np.repeat(length > 1, length)]

    places = np.arange(n)
    sorted_first = first[order]
    # Suffixes shorter than eight bytes tie with none: the padding is not part of them.
    short = order > n - 8
    new = np.ones(n, dtype=bool)
    new[1:] = (sorted_first[1:] != sorted_first[:-1]) | short[1:] | short[:-1]
    ties, h = group(places, new), 8
    while h < depth and len(ties):
        step = min(h, depth - h)
        rows = order[ties]
        ahead = rows + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        own = rank[rows]
        by = np.lexsort((second, own))
        order[ties] = rows[by]
        own, second = own[by], second[by]
        new = np.ones(len(ties), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (second[1:] != second[:-1])
        ties, h = group(ties, new), h + step
    return order, rank


def kasai(data: np.ndarray, order: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix of ``order`` with the one before it, within their contexts (``end`` by place).

    As Kasai's method goes in text order and loses at most one byte a step: where
    suffix i follows i' in the order and i-1 followed i'-1 with at least one byte in
    common, their common prefix is one less; all other suffixes are compared, eight
    bytes at a time, together.  (Nothing in common before says nothing of the next.)
    """
    n = len(data)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    chain = np.zeros(n, dtype=bool)
    chain[1:] = (before[1:] >= 0) & (before[:-1] >= 0) & (before[1:] == before[:-1] + 1) & (end[1:] == end[:-1])
    chain[1:] &= np.where(before[1:] >= 0, end[np.maximum(before[1:], 0)] == end[np.maximum(before[:-1], 0)], False)
    chain[1:] &= data[:-1] == data[np.maximum(before[:-1], 0)]
    common = np.zeros(n, dtype=np.int64)
    heads = np.flatnonzero((before >= 0) & ~chain)
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    words = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        words |= padded[k:n + k].astype(np.uint64) << np.uint64(8 * k)
    todo, at = heads, np.zeros(len(heads), dtype=np.int64)
    while len(todo):
        i, j = todo + at, before[todo] + at
        room = np.minimum(end[todo] - i, end[before[todo]] - j)
        live = room > 0
        differ = words[np.minimum(i, n - 1)] ^ words[np.minimum(j, n - 1)]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8)
        gain = np.where(live, np.minimum(same, np.maximum(room, 0)), 0)
        common[todo] = at + gain
        on = live & (gain == 8)
        todo, at = todo[on], at[on] + 8
    # Chains: one less per step from their head.
    head_of = np.maximum.accumulate(np.where(chain, 0, np.arange(n)))
    common = np.where(chain, common[head_of] - (np.arange(n) - head_of), common)
    return common[order]


class Shard:
    """A suffix array over the bytes of some contexts, of which only window starts are kept."""

    def __init__(self, blobs: list[bytes], windows: np.ndarray, window: int = WINDOW):
        self.window = window
        self.data = np.frombuffer(b"".join(blobs), dtype=np.uint8)
        size = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs))
        self.ends = np.cumsum(size)
        self.begins = self.ends - size
        order, _ = refine(self.data, window)
        of = np.repeat(np.arange(len(blobs)), size)
        start = np.arange(len(self.data)) - self.begins[of] < windows[of]
        self.order = order[start[order]]
        self.of = of
        common = kasai(self.data, self.order, self.ends[of])
        same = common[1:] >= window
        self.repeats = np.zeros(len(self.order), dtype=bool)
        self.repeats[1:] |= same
        self.repeats[:-1] |= same

    def strings(self, a: int, b: int) -> np.ndarray:
        """The windows a..b-1 of the order, as fixed-length byte strings."""
        view = np.lib.stride_tricks.sliding_window_view(self.data, self.window)
        return np.ascontiguousarray(view[self.order[a:b]]).view(f"S{self.window}").reshape(-1)

    def place(self, string: bytes, after: bool) -> int:
        """How many windows are smaller than ``string`` (``after``: or equal), by binary search."""
        find = bisect_right if after else bisect_left
        return find(self.order, string, key=lambda i: self.data[i:i + self.window].tobytes())

    def merge(self, other: Shard) -> None:
        """Find the windows of ``other`` here by binary search; those found repeat in both.

        Both orders are walked in slices of ``SLICE`` windows: those of a slice of
        ``other`` can only stand between the places of its first and last window here.
        """
        edge = np.zeros(len(self.order) + 1, dtype=np.int64)
        for first in range(0, len(other.order), SLICE):
            theirs = other.strings(first, first + SLICE)
            ends = other.order[[first, min(first + SLICE, len(other.order)) - 1]]
            low, high = (other.data[i:i + self.window].tobytes() for i in ends)
            a, b = self.place(low, False), self.place(high, True)
            left = np.full(len(theirs), a)
            right = left.copy()
            for at in range(a, b, SLICE):
                mine = self.strings(at, min(at + SLICE, b))
                left += np.searchsorted(mine, theirs, side="left")
                right += np.searchsorted(mine, theirs, side="right")
            hit = right > left
            other.repeats[first:first + SLICE] |= hit
            np.add.at(edge, left[hit], 1)
            np.add.at(edge, right[hit], -1)
        self.repeats |= np.cumsum(edge[:-1]) > 0

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """(context, window in it) of all windows that repeat."""
        at = self.order[self.repeats]
        return self.of[at], at - self.begins[self.of[at]]


def runs(of: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers ``at`` of each ``of`` as (of, first, length) of consecutive ones."""
    if not len(of):
        return of, at, at
    by = np.lexsort((at, of))
    of, at = of[by], at[by]
    new = np.ones(len(of), dtype=bool)
    new[1:] = (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return of[first], at[first], np.diff(np.append(first, len(of)))


def find_contexts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row per context (``RECORD``), and one per document, with n_bytes and the digest of all of it, part null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch.column(2), _SAME):
                c = contexts(texts)
                m, d = len(c["of"]), len(texts)
                rows = pa.array(np.concatenate((np.arange(d), c["of"])) + first, pa.int64())
                cols = [batch.column(0).take(rows), batch.column(1).take(rows)]
                for name in ("lo", "n", "a", "p0", "p1"):
                    head = np.fromiter(map(len, texts), dtype=np.int32, count=d) if name == "lo" else np.zeros(d, dtype=np.int32)
                    cols.append(pa.array(np.concatenate((head, c[name])).astype(np.int32)))
                for name in ("part", "ctx"):
                    cols.append(pa.concat_arrays([pa.nulls(d, pa.int64()), pa.array(c[name].astype(np.uint64).view(np.int64), pa.int64())]))
                cols.append(pa.concat_arrays([pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()), pa.nulls(m, pa.string())]))
                yield pa.RecordBatch.from_arrays(cols, names=["key", "th", "lo", "n", "a", "p0", "p1", "part", "ctx", "sha"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"), text)
    return rows.mapInArrow(run, RECORD + ", sha string")


def fetch(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """The contexts of ``wanted`` with their bytes (column ``blob``)."""
    listed = wanted.groupBy("key", "th").agg(F.collect_list(F.struct("lo", "n", "a", "p0", "p1", "part", "copies")).alias("c"))
    l = listed.select(F.col("key").alias("k"), F.col("th").alias("h"), "c")
    texts = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"), F.col(text).alias("text"))
    return (texts.join(l, F.col("key").eqNullSafe(F.col("k")) & (F.col("th") == F.col("h")))
            .select("key", "th", F.col("text").cast("binary").alias("bytes"), F.explode("c").alias("c"))
            # Copies of a row give a context once more each; such have ``copies`` over one and only serve as partners.
            .select("key", "th", "c.*", F.expr(f"substring(bytes, c.lo + 1, c.n + {WINDOW - 1})").alias("blob")))


def narrowed(wide: DataFrame) -> DataFrame:
    """Contexts of wide keys by halves of their part of the window, filed anew by what these share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                prefix = prefix_hash(byte_values(r["blob"]))
                a, middle = r["a"] - r["lo"], (r["p0"] + r["p1"]) // 2
                for p0, p1 in ((r["p0"], middle), (middle + 1, r["p1"])):
                    first, last = max(0, a - p1), min(r["n"] - 1, a - p0)  # windows of this half
                    if first > last:
                        continue
                    x = [np.array([v]) for v in (first, last - first + 1, a, p0, p1)]
                    rows.append(r | {"lo": r["lo"] + first, "n": last - first + 1, "p0": p0, "p1": p1,
                                     "part": int(part_hash(prefix, x[2], x[3], x[4]).view(np.int64)[0]),
                                     "ctx": int(context_hash(prefix, x[0], x[1], x[2]).view(np.int64)[0]),
                                     "blob": r["blob"][first:last + WINDOW]})
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    cols = ["key", "th", "lo", "n", "a", "p0", "p1", "part", "ctx", "copies", "blob"]
    return wide.select(*cols).mapInArrow(run, RECORD + ", copies long, blob binary")


def shard_repeats(dealt: DataFrame) -> DataFrame:
    """(key, th, lo, n): runs of repeated windows of contexts found once, by suffix arrays over whole keys."""

    def solve(held: list[tuple[int, list[dict]]]) -> Iterator[pa.RecordBatch]:
        """``held``: (part, contexts).  Whole keys share a shard while it has room; a key beyond it gets several."""
        shards, sizes = [[]], [0]
        spans: list[tuple[int, int]] = []  # shards of one key
        for _, rows in held:
            first = len(shards) - 1
            for r in rows:
                if sizes[-1] >= SHARD_BYTES:
                    shards.append([])
                    sizes.append(0)
                shards[-1].append(r)
                sizes[-1] += len(r["blob"])
            spans.append((first, len(shards) - 1))
        built = [Shard([r["blob"] for r in s], np.array([r["n"] for r in s])) for s in shards if s]
        done = set()
        for a, b in spans:
            for i in range(a, b + 1):
                for j in range(i + 1, b + 1):
                    if (i, j) not in done:
                        done.add((i, j))
                        built[i].merge(built[j])
        for shard, rows in zip(built, shards):
            of, at = shard.repeated()
            of, at, n = runs(of, at)
            out = [(rows[o]["key"], rows[o]["th"], rows[o]["lo"] + x, m) for o, x, m in zip(of.tolist(), at.tolist(), n.tolist()) if rows[o]["copies"] == 1]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                                                 names=["key", "th", "lo", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if held and held[-1][0] == r["part"]:
                    held[-1][1].append(r)
                else:
                    if size >= SHARD_BYTES:
                        yield from solve(held)
                        held, size = [], 0
                    held.append((r["part"], [r]))
                size += len(r["blob"])
        if held:
            yield from solve(held)

    cols = ["key", "th", "lo", "n", "part", "copies", "blob"]
    return dealt.select(*cols).repartition("part").sortWithinPartitions("part").mapInArrow(run, "key long, th long, lo int, n int")


def classify(records: DataFrame, kept: list[str], wide: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split the contexts of ``records`` whose key occurs twice or more.

    Returns (repeated: key, th, lo, n of contexts found more than once; mixed: one
    row per different context of keys that have several, with ``copies``; wide: the
    same of keys with more than ``wide`` different ones).
    """
    row = F.struct("key", "th", "lo", "n", "a", "p0", "p1", *kept)
    each = records.groupBy("part", "ctx").agg(F.count(F.lit(1)).alias("copies"), F.min_by(row, F.struct("key", "th", "lo")).alias("r"))
    each = written(each.select("part", "ctx", "copies", "r.*"), "suffix-contexts")
    several = written(each.groupBy("part").agg(F.count(F.lit(1)).alias("different")).filter(F.col("different") > 1), "suffix-several")
    mixed = each.join(several, "part")
    again = each.filter(F.col("copies") > 1).select(F.col("part").alias("p"), F.col("ctx").alias("c"))
    repeated = (records.join(again, (F.col("part") == F.col("p")) & (F.col("ctx") == F.col("c")))
                .select("key", "th", "lo", "n"))
    return repeated, mixed.filter(F.col("different") <= wide).drop("different"), mixed.filter(F.col("different") > wide).drop("different")


def cut(joined: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes) of (key, bytes, runs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, t, found in zip(batch.column(0), batch.column(1), batch.column(2)):
                data = np.frombuffer(t.as_py(), dtype=np.uint8)
                cover = np.zeros(len(data) + 1, dtype=np.int64)
                lo = found.values.field("lo").to_numpy()
                np.add.at(cover, lo, 1)
                np.add.at(cover, lo + found.values.field("n").to_numpy() + window - 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                left = data[~gone].tobytes()
                rows.append((key.as_py(), len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), left))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)],
                                             names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])

    return joined.mapInArrow(run, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")


def repeated_runs(docs: DataFrame, seen: DataFrame, key: str, text: str, wide: int = WIDE) -> DataFrame:
    """(key, th, runs): the starts of repeated windows of each document that has any, as runs (lo, n).

    ``seen`` is the written table of ``find_contexts`` and is deleted once read.
    """
    records = seen.filter(F.col("part").isNotNull()).drop("sha")
    # Written, so that the join is one of two plain tables: Spark broadcasts a small one and may split a frequent part.
    twice = written(records.groupBy("part").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1).select("part"), "suffix-twice")
    hits = written(records.join(twice, "part"), "suffix-candidates")
    discard(seen)
    discard(twice)
    release(docs.sparkSession)
    repeated, mixed, broad = classify(hits, [], wide)
    found = [written(repeated, "suffix-repeated")]
    discard(hits)
    release(docs.sparkSession)
    fetched = written(fetch(docs, mixed, key, text), "suffix-bytes")
    release(docs.sparkSession)
    found.append(written(shard_repeats(fetched), "suffix-shards"))
    level = None
    while not broad.isEmpty():
        level = fetch(docs, broad, key, text).withColumn("ctx", F.lit(0).cast("long")) if level is None else broad
        finer = written(narrowed(level), "suffix-narrowed")
        kept = ["blob"]
        repeated, mixed, broad = classify_weighted(finer, kept, wide)
        found += [written(repeated, "suffix-repeated"), written(shard_repeats(mixed), "suffix-shards")]
    every = found[0]
    for f in found[1:]:
        every = every.union(f)
    return written(every.groupBy("key", "th").agg(F.collect_list(F.struct("lo", "n")).alias("runs")), "suffix-runs")


def classify_weighted(records: DataFrame, kept: list[str], wide: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``classify`` of contexts that each stand for ``copies`` places; those of one place alone need a result."""
    row = F.struct("key", "th", "lo", "n", "a", "p0", "p1", *kept)
    each = records.groupBy("part", "ctx").agg(F.sum("copies").alias("all"), F.min_by(row, F.struct("key", "th", "lo")).alias("r"))
    each = written(each.select("part", "ctx", F.col("all").alias("copies"), "r.*"), "suffix-contexts")
    several = written(each.groupBy("part").agg(F.count(F.lit(1)).alias("different")).filter(F.col("different") > 1), "suffix-several")
    mixed = each.join(several, "part")
    again = each.filter(F.col("copies") > 1).select(F.col("part").alias("p"), F.col("ctx").alias("c"))
    repeated = (records.filter(F.col("copies") == 1).join(again, (F.col("part") == F.col("p")) & (F.col("ctx") == F.col("c")))
                .select("key", "th", "lo", "n"))
    return repeated, mixed.filter(F.col("different") <= wide).drop("different"), mixed.filter(F.col("different") > wide).drop("different")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", wide: int = WIDE) -> DataFrame:
    """Per document: key, n_bytes, n_removed, n_spans, kept_sha256 and kept_bytes (null: nothing was removed).

    A byte goes if a 200-byte string that covers it also starts anywhere else, in
    this document or another.  Null and empty texts have no bytes; shorter texts than
    200 bytes lose none.  Rows are told apart by key and a text hash; copies of
    both repeat each other and are all kept, null keys too.  An empty table gives no
    rows.  Kept bytes may end inside a character.
    """
    seen = written(find_contexts(docs, key, text), "suffix-records")
    digests = written(seen.filter(F.col("sha").isNotNull()).select("key", "th", "lo", "sha"), "suffix-digests")
    lost = repeated_runs(docs, seen, key, text, wide).select(F.col("key").alias("k"), F.col("th").alias("h"), "runs")
    release(docs.sparkSession)
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("th") == F.col("h"))
    texts = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"),
                        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))
    gone = cut(texts.join(lost, same).select("key", "bytes", "runs"))
    whole = (digests.join(lost.select("k", "h"), same, "left_anti")
             .select("key", F.col("lo").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                     F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("binary").alias("kept_bytes")))
    return gone.union(whole)


@pandas_udf(StringType())
def _kept_text(texts, found):  # noqa: ANN001, ANN202  (pandas series)
    """Each text without its repeated bytes; characters that lost a byte go whole.  Null texts stay null."""
    import pandas as pd

    out = []
    for t, r in zip(texts, found):
        if t is None:
            out.append(None)
            continue
        data = np.frombuffer(t.encode(), dtype=np.uint8)
        cover = np.zeros(len(data) + 1, dtype=np.int64)
        for x in r:
            cover[x["lo"]] += 1
            cover[x["lo"] + x["n"] + WINDOW - 1] -= 1
        out.append(data[np.cumsum(cover[:-1]) == 0].tobytes().decode("utf-8", "ignore"))
    return pd.Series(out, dtype=object)


def dedup_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", wide: int = WIDE) -> DataFrame:
    """``docs``, all rows and columns, with repeated bytes taken out of ``text``; see ``dedup``."""
    seen = written(find_contexts(docs, key, text), "suffix-records")
    lost = repeated_runs(docs, seen, key, text, wide).select(F.col("key").alias("__k"), F.col("th").alias("__h"), F.col("runs").alias("__runs"))
    release(docs.sparkSession)
    same = F.col(key).cast("long").eqNullSafe(F.col("__k")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("__h"))
    joined = docs.join(lost, same, "left")
    cut_text = _kept_text(F.when(F.col("__runs").isNotNull(), F.col(text)), F.col("__runs"))
    return joined.withColumn("__cut", cut_text).select(*[
        F.when(F.col("__runs").isNotNull(), F.col("__cut")).otherwise(F.col(c)).alias(c) if c == text else F.col(c) for c in docs.columns])
