"""Substring dedup of word windows with a count-min prefilter.

1. Every task counts the distinct window hashes of its documents in a count-min
   sketch whose counters stop at two; tasks send only the counters they touched,
   and merging adds them block by block.
2. A window can occur in two documents only if each of its counters reached
   two.  Windows below that, nearly all, go no further; none that repeats is
   lost, as a sketch only overestimates.  The others are grouped exactly by hash,
   which gives the first document of each, and every later document learns which
   of its windows to remove.

The merged sketch has at most ``ROWS`` x 2^``BITS`` bits, whatever the corpus;
when it fills up, more windows are grouped exactly and the result stays the same.
Hot windows are combined before the shuffle, and the join back has one row per
window on its side, so that the other side can be split.

Documents whose words are all those of an earlier document, in order, lose every
word and are no first document of any window.  They are found by their hashes in
step 1; a bitmap of fixed size tells step 2 to skip them.  Its bits are cleared
where any other document has the same bit, so it never names a wrong one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import Words, byte_values, discard, mix, prefix_hash, range_hash, release, text_chunks, written

WINDOW = 13
# The sketch: rows of at most 2^BITS counters, in blocks of 2^BLOCK that travel together; bits of the bitmap of copies.
ROWS, BITS, BLOCK, COPY_BITS = 2, 28, 20, 24
# Distinct hashes that a task holds before it sends its counters.
TASK_HASHES = 1 << 20

# White space that parts words becomes a blank; all other bytes stay.
_BLANKS = bytes(32 if 9 <= b <= 13 else b for b in range(256))


def distinct_windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the windows of each text, each hash once per text."""
    at, hashes = words.windows(n)
    of = words.of[at]
    order = np.lexsort((of, hashes))
    h, t = hashes[order], of[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return t[first], h[first]


def slots(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The counter of each hash in a row of the sketch (two rows: its upper and its lower bits)."""
    return (hashes >> np.uint64(0 if row else 64 - bits)) & np.uint64((1 << bits) - 1)


def _pack(x: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(x, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(x: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(4, -1).T).reshape(-1).view("<u4"), dtype=np.int64)


def sequence_hashes(words: Words) -> np.ndarray:
    """A row of two 64-bit hashes per text: of its words in order."""
    out = np.zeros((len(words.count), 2), dtype=np.uint64)
    for seed in (1, 2):
        each = range_hash(prefix_hash(byte_values(words.data, seed)), words.start, words.end)
        each = prefix_hash(mix(each + (words.end - words.start).astype(np.uint64)))
        out[:, seed - 1] = range_hash(each, words.first, words.first + words.count) + words.count.astype(np.uint64)
    return out


def copy_bits(keys: np.ndarray) -> np.ndarray:
    """The bit of each key in the bitmap of copies; rows of one key share it."""
    return (mix(keys.astype(np.int64).view(np.uint64)) >> np.uint64(64 - COPY_BITS)).astype(np.int64)


def partial_sketches(docs: DataFrame, key: str, text: str, window: int, rows: int, bits: int) -> DataFrame:
    """(row, block, once, more): the counters of a block that a task found touched once, and more often; and a
    row per document that has a key: key, s1, s2 (its sequence hashes) and bit."""

    def counters(hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        for row in range(rows):
            s = np.sort(slots(hashes, row, bits).astype(np.uint32))
            edge = np.concatenate(([0], np.flatnonzero(s[1:] != s[:-1]) + 1, [len(s)]))
            value, count = s[edge[:-1]], np.diff(edge)
            block = value >> np.uint32(BLOCK)
            for part in np.split(np.arange(len(value)), np.flatnonzero(np.diff(block)) + 1):
                low = value[part] & np.uint32((1 << BLOCK) - 1)
                again = count[part] > 1
                yield pa.RecordBatch.from_pylist([{"row": row, "block": int(block[part[0]]), "once": _pack(low[~again]),
                                                   "more": _pack(low[again])}], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for first, texts in text_chunks(batch.column(1), _BLANKS):
                words = Words(texts)
                own = batch.column(0)[first:first + len(texts)]
                named = np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False))
                if len(named):
                    s, k = sequence_hashes(words)[named], own.take(pa.array(named)).to_numpy()
                    nulls = [pa.nulls(len(k), f.type) for f in schema][:4]
                    yield pa.RecordBatch.from_arrays([*nulls, *map(pa.array, (k, s[:, 0].view(np.int64), s[:, 1].view(np.int64), copy_bits(k)))], schema=schema)
                held.append(distinct_windows(words, window)[1])
                size += len(held[-1])
                if size >= TASK_HASHES:
                    yield from counters(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield from counters(np.concatenate(held))

    schema = pa.schema([("row", pa.int32()), ("block", pa.int32()), ("once", pa.binary()), ("more", pa.binary()),
                        ("key", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bit", pa.int64())])
    return docs.select(F.col(key).cast("long"), text).mapInArrow(
        run, "row int, block int, once binary, more binary, key long, s1 long, s2 long, bit long")


def copies_bitmap(partial: DataFrame) -> np.ndarray:
    """The bitmap of copies: 2^COPY_BITS bits at the driver, set where all documents of a bit are copies."""
    seen = partial.filter(F.col("bit").isNotNull()).select("key", "s1", "s2", "bit")
    first = seen.groupBy("s1", "s2").agg(F.min("key").alias("first"))
    only = (seen.join(first, ["s1", "s2"]).groupBy("bit").agg(F.min((F.col("key") > F.col("first")).cast("int")).alias("copy"))
            .filter("copy = 1"))
    packed = only.groupBy((F.col("bit") / 65536).cast("int").alias("b")).agg(F.collect_list((F.col("bit") % 65536).cast("int")).alias("x"))
    out = np.zeros(1 << COPY_BITS, dtype=bool)
    for r in packed.toLocalIterator():
        out[(r["b"] << 16) + np.array(r["x"], dtype=np.int64)] = True
    return np.packbits(out)


def merged_sketch(partial: DataFrame) -> DataFrame:
    """(row, block, bits): one bit per counter, set where the merged count is two or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, one, two = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"row": pa.array([now[0]], pa.int32()), "block": pa.array([now[1]], pa.int32()),
                                               "bits": pa.array([np.packbits(two).tobytes()], pa.binary())})

        for batch in batches:
            for r in batch.to_pylist():
                if (r["row"], r["block"]) != now:
                    if now is not None:
                        yield done()
                    now = (r["row"], r["block"])
                    one, two = np.zeros(1 << BLOCK, dtype=bool), np.zeros(1 << BLOCK, dtype=bool)
                once, more = _unpack(r["once"]), _unpack(r["more"])
                two[once[one[once]]] = True
                one[once] = True
                two[more] = one[more] = True
        if now is not None:
            yield done()

    touched = partial.filter(F.col("row").isNotNull()).select("row", "block", "once", "more")
    return touched.repartition("row", "block").sortWithinPartitions("row", "block").mapInArrow(run, "row int, block int, bits binary")


def repeated_windows(docs: DataFrame, sketch, key: str, text: str, window: int, rows: int, bits: int) -> DataFrame:  # noqa: ANN001
    """(key, hash, n_words, copy, kept_sha256): a row per distinct window that the sketch lets pass, and one without
    a hash per document, with the digest of all its words and whether it is a copy (of which no window is listed).

    ``sketch`` is a broadcast of (table of bits by row, bitmap of copies).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, copies = sketch.value

        def bit(table: np.ndarray, s: np.ndarray) -> np.ndarray:
            s = s.astype(np.int64)
            return (table[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & np.uint8(1) == 1

        def passes(h: np.ndarray, keep: np.ndarray) -> np.ndarray:
            for row in range(rows):
                keep = keep[bit(tables[row], slots(h[keep], row, bits))] if row in tables else keep[:0]
            return keep

        for batch in batches:
            for first, texts in text_chunks(batch.column(1), _BLANKS):
                words = Words(texts)
                own = batch.column(0)[first:first + len(texts)]
                named = own.is_valid().to_numpy(zero_copy_only=False)
                k = own.fill_null(0).to_numpy()
                copy = named & bit(copies, copy_bits(k))
                of, h = distinct_windows(words, window)
                keep = passes(h, np.flatnonzero((named & ~copy)[of]))
                digests = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([own, own.take(pa.array(of[keep], pa.int64()))]),
                    pa.concat_arrays([pa.nulls(len(texts), pa.int64()), pa.array(h[keep].view(np.int64), pa.int64())]),
                    pa.concat_arrays([pa.array(words.count, pa.int64()), pa.nulls(len(keep), pa.int64())]),
                    pa.concat_arrays([pa.array(copy), pa.nulls(len(keep), pa.bool_())]),
                    pa.concat_arrays([pa.array(digests, pa.string()), pa.nulls(len(keep), pa.string())])],
                    names=["key", "hash", "n_words", "copy", "kept_sha256"])

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, "key long, hash long, n_words long, copy boolean, kept_sha256 string")


def remove_windows(joined: DataFrame, window: int) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256, text) of (key, text, hashes): words covered by a listed window go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, digests, kept = [], [], [], []
            for t, hs in zip(batch.column(1), batch.column(2)):
                data = (t.as_py() or "").encode("utf-8", "surrogatepass").translate(_BLANKS)
                words = Words([data])
                at, h = words.windows(window)
                hit = at[np.isin(h, hs.values.to_numpy().view(np.uint64))]
                cover = np.zeros(len(words.start) + 1, dtype=np.int64)
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + window, -1)
                gone = np.cumsum(cover[:-1]) > 0
                left = b" ".join(data[a:b] for a, b in zip(words.start[~gone].tolist(), words.end[~gone].tolist()))
                counts.append(len(gone))
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(0), pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(digests, pa.string()), pa.array(kept, pa.string())],
                                             names=["key", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return joined.mapInArrow(run, "key long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def sketch_bits(docs: DataFrame, text: str, most: int = BITS) -> int:
    """Counters in a row, as a power of two: about two per window, as far as ``most`` allows."""
    chars = docs.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    return max(BLOCK, min(most, (chars // 3).bit_length()))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, rows: int = ROWS, bits: int | None = None) -> DataFrame:
    """Per document: key, n_words, n_removed, kept_sha256 and kept_text (null where nothing or everything was removed).

    A word goes if some window of ``window`` words that covers it also starts in
    a document with a smaller key.  Null and empty texts have no words; texts
    shorter than a window lose none.  Documents without a key neither lose words
    nor cost others any.  Rows that repeat a key are judged alike and all kept;
    an empty table gives no rows.  Windows are compared by 64-bit hashes, whole
    documents by 128 bits.
    """
    spark = docs.sparkSession
    bits = sketch_bits(docs, text) if bits is None else bits
    partial = written(partial_sketches(docs, key, text, window, rows, bits), "countmin-partial")
    # At most rows * 2^bits bits, whatever the corpus.
    tables: dict[int, np.ndarray] = {}
    for r in merged_sketch(partial).toLocalIterator():
        table = tables.setdefault(r["row"], np.zeros(1 << (bits - 3), dtype=np.uint8))
        table[r["block"] << (BLOCK - 3):(r["block"] + 1) << (BLOCK - 3)] = np.frombuffer(r["bits"], dtype=np.uint8)
    sketch = spark.sparkContext.broadcast((tables, copies_bitmap(partial)))
    del tables
    discard(partial)
    release(spark)
    seen = written(repeated_windows(docs, sketch, key, text, window, rows, bits), "countmin-windows")
    sketch.unpersist()
    windows = seen.filter(F.col("hash").isNotNull()).select("key", "hash")
    first = windows.groupBy("hash").agg(F.min("key").alias("first"))
    later = windows.join(first, "hash").filter(F.col("key") > F.col("first")).select("key", "hash")
    lost = written(later.groupBy("key").agg(F.collect_set("hash").alias("hashes")), "countmin-lost")
    digests = written(seen.filter(F.col("hash").isNull()).drop("hash"), "countmin-digests")
    discard(seen)
    release(spark)
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    cut = remove_windows(texts.join(lost, "key").select("key", "text", "hashes"), window)
    # A copy has the words of an earlier document and loses all, if they make a window.
    all_gone = F.col("copy") & (F.col("n_words") >= window)
    whole = (digests.join(lost.select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left_anti")
             .select("key", "n_words", F.when(all_gone, F.col("n_words")).otherwise(0).alias("n_removed"),
                     F.when(all_gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
                     F.lit(None).cast("string").alias("kept_text")))
    return cut.union(whole)
