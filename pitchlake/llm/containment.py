"""Benchmark decontamination: size-partitioned MinHash containment search.

An item of q distinct five-word shingles is contained in a document when the
document holds at least need = ceil(t * q) of them.  Items are partitioned by
size, and each partition's MinHash sketch keeps the m = q - need + 1 least
shingle hashes of the item: of any need shingles at least one is among these m,
so a document that contains an item always shares a sketch value with it,
however long the document is.  Documents with fewer than need shingles skip a
partition.  Candidates are verified by exact shingle containment on the words.

The benchmark is the stated query set.  It is passed to the tasks in blocks of
a fixed number of shingles, one pass over the documents per block.  A block's
rows are written before the next one is fetched, so the driver holds one block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import Words, text_chunks, written

SHINGLE, THRESHOLD = 5, 0.8
# Item shingles that go to the tasks at once (about 100 bytes each).
BLOCK_SHINGLES = 200_000

# Bytes of words: ASCII letters (lower-cased) and digits, and all of non-ASCII characters; others part words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def word_bytes(text: str | None) -> bytes:
    """The words of a text, A-Z lower-cased, with blanks for all that parts them."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS)


def shingle_texts(data: bytes, n: int = SHINGLE) -> set[bytes]:
    """The distinct shingles themselves."""
    words = data.split()
    n = min(n, len(words))
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def item_blocks(benchmark: DataFrame, key: str, text: str, block_shingles: int) -> Iterator[list[tuple[int, str]]]:
    """Rows of the benchmark in blocks of a bounded number of words, fetched one partition at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).dropna().toLocalIterator():
        block.append((r["k"], r["t"]))
        size += len(word_bytes(r["t"]).split())
        if size >= block_shingles:
            yield block
            block, size = [], 0
    if block:
        yield block


def contained(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
              item_text: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE,
              block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(key, item, shared, size, containment) for every document that holds an item at ``threshold`` or more.

    Items and documents without a word (null, empty, blank) match nothing; an
    item shorter than a shingle is one shingle of all its words.  Rows without
    a key still match (their key is null); items without a key are left out.
    Repeated rows give their rows each.  Either table empty: no rows.
    """
    schema = "key long, item long, shared long, size long, containment double"
    spark, paths = docs.sparkSession, []
    for block in item_blocks(benchmark, item_key, item_text, block_shingles):
        found = docs.select(F.col(key).cast("long"), text).mapInArrow(_search(block, threshold, shingle), schema)
        paths.append(written(found, "contained-items")._written_to)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


class _Partition:
    """Items of one shingle width and size class: their sketch values, sorted, with the item of each."""

    def __init__(self, entries: list[tuple[int, int]], least: int):
        entries.sort()
        self.values = np.array([h for h, _ in entries], dtype=np.uint64)
        self.owners = np.array([i for _, i in entries])
        self.least = least  # the smallest need of the class
        self.maybe = np.zeros(1 << 16, dtype=bool)  # by the first 16 bits
        self.maybe[self.values >> np.uint64(48)] = True

    def candidates(self, hashes: np.ndarray, of: np.ndarray, sizes: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs that share a sketch value, of texts that are long enough."""
        some = np.flatnonzero(self.maybe[hashes >> np.uint64(48)])
        some = some[sizes[of[some]] >= self.least]
        a = np.searchsorted(self.values, hashes[some], side="left")
        b = np.searchsorted(self.values, hashes[some], side="right")
        hit = b > a
        return {(t, i) for t, x, y in zip(of[some][hit].tolist(), a[hit].tolist(), b[hit].tolist()) for i in self.owners[x:y].tolist()}


def _search(block: list[tuple[int, str]], threshold: float, shingle: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, classes = [], {}
        for k, t in block:
            data = word_bytes(t)
            texts = shingle_texts(data, shingle)
            if not texts:
                continue
            width = min(shingle, len(data.split()))  # words in its shingles
            need = math.ceil(threshold * len(texts) - 1e-9)
            sketch = np.unique(Words([data]).windows(width)[1])[:len(texts) - need + 1]
            classes.setdefault((width, need.bit_length()), []).extend((h, len(items)) for h in sketch.tolist())
            items.append((k, texts, need))
        parts = {(w, size): _Partition(v, 1 << (size - 1)) for (w, size), v in classes.items()}
        for batch in batches:
            keys, rows = batch.column(0), []
            for first, texts in text_chunks(batch.column(1), _WORDS):
                words = Words(texts)
                for width in {w for w, _ in parts}:
                    at, hashes = words.windows(width)
                    sizes = np.maximum(words.count - width + 1, 0)
                    found = set().union(*(p.candidates(hashes, words.of[at], sizes) for (w, _), p in parts.items() if w == width))
                    own_of: dict[int, set[bytes]] = {}
                    for t, i in sorted(found):
                        own = own_of.get(t) or own_of.setdefault(t, shingle_texts(texts[t], width))
                        item, wanted, need = items[i]
                        shared = len(wanted & own)
                        if shared >= need:
                            rows.append((keys[first + t].as_py(), item, shared, len(wanted), shared / len(wanted)))
            names = ["key", "item", "shared", "size", "containment"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if i == 4 else pa.int64()) for i, c in enumerate(
                zip(*rows) if rows else [()] * 5)], names=names)

    return run
