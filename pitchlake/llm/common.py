"""Shared helpers: written tables, word splitting, byte hashing, worker caches."""

from __future__ import annotations

import sys
import types

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.session import scratch_path
from pitchlake.sinks.layout import delete_path

# ASCII white space, and the words between it (Java regular expressions).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Rows per Arrow batch: texts of a batch are in a worker's memory at once.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> None:
    """Session settings of this subpackage: small Arrow batches, as texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table of ``written`` that nothing reads any more."""
    delete_path(table.sparkSession, table._written_to)


def release(spark: SparkSession) -> None:
    """Let the driver's JVM collect its garbage, so that shuffle files of finished steps are deleted."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def words_of(text: Column) -> Column:
    """The words of a text (runs without ASCII white space); null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker (tasks of one worker share it)."""
    holder = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache"))
    return holder.__dict__.setdefault(name, {})


# ---------------------------------------------------------------------------
# Hashes of byte ranges: h(range) = sum of value(byte j) * B^(j - start) mod 2^64,
# taken from prefix sums, so any range of a buffer costs a few operations.
# ---------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _values(seed: int) -> np.ndarray:
    """256 pseudo-random 64-bit values, one per byte (splitmix64)."""
    x = (np.arange(1, 257, dtype=np.uint64) + np.uint64(seed * 1000)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums (splitmix64's last steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and the inverse powers, mod 2^64; kept per worker and grown when needed."""
    kept = worker_cache(f"powers-{base}")
    if "up" not in kept or len(kept["up"]) <= n:
        size = max(1 << 16, 1 << (n + 1).bit_length())
        for key, b in (("up", base), ("down", pow(base, -1, 1 << 64))):
            a = np.ones(size, dtype=np.uint64)
            a[1:] = np.uint64(b)
            kept[key] = np.multiply.accumulate(a)
    return kept["up"], kept["down"]


def prefix_hash(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Prefix sums of ``values[j] * base^j`` (one longer than ``values``)."""
    up, _ = powers(len(values), base)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Mixed hashes of the ranges [start, end) of the sequence that ``prefix`` sums up."""
    _, down = powers(len(prefix), base)
    return mix((prefix[end] - prefix[start]) * down[start])


def byte_values(data: bytes | np.ndarray, seed: int = 1) -> np.ndarray:
    """The 64-bit value of each byte."""
    table = worker_cache("byte-values")
    if seed not in table:
        table[seed] = _values(seed)
    return table[seed][np.frombuffer(data, dtype=np.uint8) if isinstance(data, bytes) else data]


# Bytes of texts that one vectorised pass takes (a longer text is a pass of its own).
CHUNK_BYTES = 1 << 19


def text_chunks(texts, table: bytes):  # noqa: ANN001, ANN201
    """Split an Arrow text column into passes: (first row, the texts' bytes by ``table``), null as empty."""
    first, held, size = 0, [], 0
    for t in texts:
        data = (t.as_py() or "").encode("utf-8", "surrogatepass").translate(table)
        if held and size + len(data) > CHUNK_BYTES:
            yield first, held
            first, held, size = first + len(held), [], 0
        held.append(data)
        size += len(data) + 1
    if held:
        yield first, held


_WORD_BASE = 0xD6E8FEB86659FD93


class Words:
    """The blank-separated words of several texts at once: byte spans, text numbers and hashes."""

    def __init__(self, texts: list[bytes]):
        self.data = b" ".join(texts)
        inside = np.frombuffer(self.data, dtype=np.uint8) != 32
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        text_end = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
        self.of = np.searchsorted(text_end, self.start, side="right")
        self.count = np.bincount(self.of, minlength=len(texts)) if len(texts) else np.zeros(0, dtype=np.int64)
        self.first = np.cumsum(self.count) - self.count

    def windows(self, n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(first word, 64-bit hash) of every run of ``n`` words of one text."""
        if len(self.start) < n:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        words = range_hash(prefix_hash(byte_values(self.data, seed)), self.start, self.end)
        words = mix(words + (self.end - self.start).astype(np.uint64))
        at = np.flatnonzero(self.of[n - 1:] == self.of[:len(self.of) - n + 1])
        return at, range_hash(prefix_hash(words, _WORD_BASE), at, at + n, _WORD_BASE)
