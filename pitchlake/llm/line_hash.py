"""Line dedup by a sharded minimal perfect hash over the distinct line hashes.

1. Every task collects the keyed lines of its documents in flushes of bounded
   size: per flush and shard (the first bits of the hash) the distinct hashes with
   their number of documents and smallest document, and which document holds which.
2. The index: per shard a minimal perfect hash of its distinct hashes, and arrays
   at the positions it gives: a 32-bit fingerprint, the number of documents, and
   the smallest document of those found in two or more.
3. Flushes probe the arrays of their shards: a request is a flush's distinct hashes
   of a shard, the reply the smallest document of each that repeats.  No line is
   joined with a line.  Replies go back to their flush, which knows the documents.

A line held by a third of all documents is one hash per flush, wherever it goes.
Shards hold ``SHARD_HASHES`` hashes on average, whatever the corpus, and a task
streams the rows of a shard and keeps the distinct ones only.  Lines are told
apart by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import discard, mix, written

MIN_CHARS = 10
# Entries (line and document) of a flush; distinct hashes of a shard, about; slots per key of a level of the hash.
FLUSH_ENTRIES, SHARD_HASHES, GAMMA = 1 << 19, 1 << 19, 2
# Marks a hash that does not repeat in a reply.
NONE = np.iinfo(np.int64).min
_BLANKS = b"\t\n\x0b\x0c\r "

ENTRY_SCHEMA = "flush string, shard int, hashes binary, docs binary, firsts binary, owner binary, owned binary"
INDEX_SCHEMA = "shard int, n long, sizes binary, bits binary, prints binary, docs binary, firsts binary"


# --- the minimal perfect hash ------------------------------------------------


def _slots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    """The slot of each (high, low) hash in a level: other mixes for other levels."""
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mix(hashes[:, 0] ^ mix(hashes[:, 1] + seed)) % np.uint64(size)).astype(np.int64)


def build_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots per level, one bit per slot) of a minimal perfect hash of distinct rows (high, low).

    Level by level, keys that have a slot for themselves set its bit; the others
    go on to the next level.  The position of a key is the number of bits set before its own.
    """
    sizes, levels, left = [], [], hashes
    while len(left):
        size = max(64, -(-GAMMA * len(left) // 8) * 8)
        s = _slots(left, len(sizes), size)
        alone = np.bincount(s, minlength=size) == 1
        levels.append(alone)
        sizes.append(size)
        left = left[~alone[s]]
    return np.array(sizes, dtype=np.int64), np.packbits(np.concatenate(levels) if levels else np.zeros(0, dtype=bool))


class PerfectHash:
    """Positions of keys by ``build_hash``'s arrays; of other keys -1 or any position."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes = sizes
        self.bits = np.unpackbits(bits).astype(bool)
        self.before = np.concatenate(([0], np.cumsum(self.bits)))

    def positions(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, dtype=np.int64)
        left, base = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            s = base + _slots(hashes[left], level, size)
            hit = self.bits[s]
            out[left[hit]] = self.before[s[hit]]
            left, base = left[~hit], base + size
        return out


def _prints(hashes: np.ndarray) -> np.ndarray:
    return (hashes[:, 1] >> np.uint64(32)).astype(np.uint32)


# --- lines -------------------------------------------------------------------


def keyed_lines(data: bytes) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text, and their keys: stripped of ASCII white space, A-Z in lower case; b"" for short ones."""
    keys = [k.strip(_BLANKS) for k in data.lower().split(b"\n")]
    # Characters of a key: its bytes that don't continue another.
    short = [len(k) < MIN_CHARS or (not k.isascii() and len(k.decode("utf-8", "surrogatepass")) < MIN_CHARS) for k in keys]
    return data.split(b"\n"), [b"" if x else k for k, x in zip(keys, short)]


def line_hashes(keys: list[bytes]) -> np.ndarray:
    """Rows (high, low) of 64 bits each."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype=">u8").astype(np.uint64).reshape(-1, 2)


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): sorts rows by hash; where each distinct one starts."""
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    h = hashes[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]).any(axis=1)
    return order, np.flatnonzero(new)


def merged(hashes: np.ndarray, docs: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes with the sum of ``docs`` (that fits 32 bits or stays at the most) and the least of ``firsts``."""
    if not len(hashes):
        return hashes, docs, firsts
    order, start = _groups(hashes)
    total = np.minimum(np.add.reduceat(docs[order].astype(np.int64), start), (1 << 32) - 1)
    return hashes[order][start], total.astype(np.uint32), np.minimum.reduceat(firsts[order], start)


def _pairs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint64).reshape(-1, 2)


def entries(docs: DataFrame, key: str, text: str, shard_bits: int) -> DataFrame:
    """Per flush and shard: distinct hashes, number of documents, smallest document, and (document, hash) pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        # A name is fixed once the rows are written; a task that runs again gives whole flushes of other names.
        name, number = uuid.uuid4().hex, 0
        held: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, owners, size, number
            h, owner = np.concatenate(held), np.concatenate(owners)
            order, start = _groups(h)
            ends = np.append(start[1:], len(order))
            owner = owner[order]
            unique = h[order][start]
            shard = (unique[:, 0] >> np.uint64(64 - shard_bits)).astype(np.int32) if shard_bits else np.zeros(len(unique), dtype=np.int32)
            edge = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(unique)]))
            of = np.repeat(np.arange(len(start)), ends - start)
            # Rows that repeat a document's key count once.
            one = np.ones(len(order), dtype=bool)
            by = np.lexsort((owner, of))
            one[by[1:]] = (of[by[1:]] != of[by[:-1]]) | (owner[by[1:]] != owner[by[:-1]])
            count = np.bincount(of[one], minlength=len(start)).astype(np.uint32)
            first = np.minimum.reduceat(owner, start)
            rows = []
            for a, b in zip(edge[:-1], edge[1:]):
                x, y = start[a], ends[b - 1]
                keep = np.flatnonzero(one[x:y]) + x
                rows.append({"flush": f"{name}-{number}", "shard": int(shard[a]), "hashes": unique[a:b].tobytes(),
                             "docs": count[a:b].tobytes(), "firsts": first[a:b].tobytes(),
                             "owner": owner[keep].tobytes(), "owned": (of[keep] - a).astype(np.uint32).tobytes()})
            held, owners, size, number = [], [], 0, number + 1
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        schema = pa.schema([("flush", pa.string()), ("shard", pa.int32()), *((c, pa.binary()) for c in ("hashes", "docs", "firsts", "owner", "owned"))])
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = dict.fromkeys(keyed_lines((t.as_py() or "").encode("utf-8", "surrogatepass"))[1])
                found.pop(b"", None)
                if found:
                    held.append(line_hashes(list(found)))
                    owners.append(np.full(len(found), k, dtype=np.int64))
                    size += len(found)
                if size >= FLUSH_ENTRIES:
                    yield flush()
        if size:
            yield flush()

    return docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long"), text).mapInArrow(run, ENTRY_SCHEMA)


def build_index(found: DataFrame) -> DataFrame:
    """Per shard: the minimal perfect hash and its arrays (``INDEX_SCHEMA``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, size = None, [], 0

        def folded() -> list:
            return [merged(*(np.concatenate(c) for c in zip(*parts)))] if parts else []

        def done() -> pa.RecordBatch:
            h, docs, firsts = folded()[0]
            sizes, bits = build_hash(h)
            at = PerfectHash(sizes, bits).positions(h)
            order = np.empty(len(h), dtype=np.int64)
            order[at] = np.arange(len(h))
            docs, firsts = docs[order], firsts[order]
            return pa.RecordBatch.from_pylist([{"shard": now, "n": len(h), "sizes": sizes.tobytes(), "bits": bits.tobytes(), "prints": _prints(h[order]).tobytes(),
                                                "docs": docs.tobytes(), "firsts": firsts[docs > 1].tobytes()}], schema=schema)

        schema = pa.schema([("shard", pa.int32()), ("n", pa.int64()), *((c, pa.binary()) for c in ("sizes", "bits", "prints", "docs", "firsts"))])
        for batch in batches:
            for shard, h, docs, firsts in zip(*(batch.column(i) for i in range(4))):
                if shard.as_py() != now:
                    if now is not None:
                        yield done()
                    now, parts, size = shard.as_py(), [], 0
                parts.append((_pairs(h.as_py()), np.frombuffer(docs.as_py(), dtype=np.uint32), np.frombuffer(firsts.as_py(), dtype=np.int64)))
                size += len(parts[-1][0])
                if size >= 2 * max(SHARD_HASHES, len(parts[0][0])):
                    parts = folded()
                    size = len(parts[0][0])
        if now is not None:
            yield done()

    return (found.select("shard", "hashes", "docs", "firsts").repartition("shard").sortWithinPartitions("shard")
            .mapInArrow(run, INDEX_SCHEMA))


class Arrays:
    """The index of a shard: looks hashes up."""

    def __init__(self, row: dict):
        self.hash = PerfectHash(np.frombuffer(row["sizes"], dtype=np.int64), np.frombuffer(row["bits"], dtype=np.uint8))
        self.prints = np.frombuffer(row["prints"], dtype=np.uint32)
        self.docs = np.frombuffer(row["docs"], dtype=np.uint32)
        self.firsts = np.frombuffer(row["firsts"], dtype=np.int64)
        self.rank = np.cumsum(self.docs > 1) - 1

    def probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of documents, 0 for lines that are not in the index; smallest document where two or more, else ``NONE``)."""
        at = self.hash.positions(hashes)
        known = at >= 0
        known[known] = self.prints[at[known]] == _prints(hashes[known])
        docs = np.zeros(len(hashes), dtype=np.int64)
        docs[known] = self.docs[at[known]]
        first = np.full(len(hashes), NONE, dtype=np.int64)
        again = docs > 1
        first[again] = self.firsts[self.rank[at[again]]]
        return docs, first


def replies(found: DataFrame, index: DataFrame) -> DataFrame:
    """(flush, shard, first): the smallest document of every distinct hash of a flush and shard, ``NONE`` if it does not repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, arrays = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["flush"] is None:
                    now, arrays = row["shard"], Arrays(row)
                elif row["shard"] == now:
                    out.append({"flush": row["flush"], "shard": row["shard"], "first": arrays.probe(_pairs(row["hashes"]))[1].tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("flush", pa.string()), ("shard", pa.int32()), ("first", pa.binary())]))

    asked = found.select("flush", "shard", "hashes")
    # The arrays of a shard come first (their flush is null), then the requests.
    return (index.unionByName(asked, allowMissingColumns=True).repartition("shard").sortWithinPartitions("shard", "flush")
            .mapInArrow(run, "flush string, shard int, first binary"))


def losses(found: DataFrame, answers: DataFrame) -> DataFrame:
    """(key, hashes): per document the hashes of its lines that go, 16 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, owner, owned, first in zip(*(batch.column(i) for i in range(4))):
                h, f = _pairs(hashes.as_py()), np.frombuffer(first.as_py(), dtype=np.int64)
                doc, line = np.frombuffer(owner.as_py(), dtype=np.int64), np.frombuffer(owned.as_py(), dtype=np.uint32)
                gone = (f[line] != NONE) & (doc > f[line])
                doc, line = doc[gone], line[gone]
                order = np.argsort(doc, kind="stable")
                doc, line = doc[order], line[order]
                edge = np.concatenate(([0], np.flatnonzero(np.diff(doc)) + 1, [len(doc)])) if len(doc) else np.zeros(1, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc[edge[:-1]], pa.int64()), pa.array([h[line[a:b]].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())], names=["key", "hashes"])

    both = found.select("flush", "shard", "hashes", "owner", "owned").join(answers, ["flush", "shard"])
    return (both.select("hashes", "owner", "owned", "first").mapInArrow(run, "key long, hashes binary")
            .groupBy("key").agg(F.collect_list("hashes").alias("hashes")))


def _without(docs: DataFrame) -> DataFrame:
    """(key, n_lines, n_dropped, kept_sha256, kept_text) of (key, text, hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, dropped, digests, kept = [], [], [], []
            for t, hashes in zip(batch.column(1), batch.column(2)):
                data = (t.as_py() or "").encode("utf-8", "surrogatepass")
                gone = {x[i:i + 16] for x in hashes.as_py() or () for i in range(0, len(x), 16)}
                if gone:
                    lines, keys = keyed_lines(data)
                    native = line_hashes(keys).tobytes()
                    left = [x for i, (x, k) in enumerate(zip(lines, keys)) if not k or native[16 * i:16 * i + 16] not in gone]
                    counts.append(len(lines))
                    dropped.append(len(lines) - len(left))
                    data = b"\n".join(left)
                else:
                    counts.append(data.count(b"\n") + 1)
                    dropped.append(0)
                digests.append(hashlib.sha256(data).hexdigest())
                kept.append(data.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()),
                                              pa.array(digests, pa.string()), pa.array(kept, pa.string())],
                                             names=["key", "n_lines", "n_dropped", "kept_sha256", "kept_text"])

    return docs.mapInArrow(run, "key long, n_lines long, n_dropped long, kept_sha256 string, kept_text string")


def shard_bits(docs: DataFrame, text: str) -> int:
    """Shards as a power of two: a shard for about every ``SHARD_HASHES`` lines of the corpus."""
    lines = docs.agg(F.sum(F.length(text).cast("long") + 1)).first()[0] or 0
    # A line with a key takes some forty characters or more; more shards than needed only make them smaller.
    return min(30, max(0, (lines // 40 // SHARD_HASHES).bit_length()))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int | None = None) -> DataFrame:
    """Per document: key, n_lines, n_dropped, kept_sha256 and kept_text, without the lines of earlier documents.

    Lines are the parts between line feeds; null and empty texts have one empty
    line.  A line goes if its key (ASCII white space stripped at both ends, A-Z
    lower-cased) has at least ``MIN_CHARS`` characters and is found in a document
    with a smaller key; repeats within one document stay or go together.
    Rows that repeat a document's key are one document for the count and all
    kept in the result; rows without a key neither lose lines nor cost others
    any.  Texts are taken whole, whatever their length; other columns are not
    read; an empty table gives no rows.
    """
    found = written(entries(docs, key, text, shard_bits(docs, text) if bits is None else bits), "lines")
    index = written(build_index(found), "line-index")
    answers = written(replies(found, index), "line-replies")
    lost = written(losses(found, answers), "line-losses")
    for table in (found, index, answers):
        discard(table)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    named = rows.filter(F.col("key").isNotNull()).join(lost, "key", "left")
    unnamed = rows.filter(F.col("key").isNull()).withColumn("hashes", F.lit(None).cast("array<binary>"))
    return _without(named.unionByName(unnamed).select("key", "text", "hashes"))
