"""Token ids in bit- or byte-plane files.

The ids of a shard (a range of documents in key order) are cut into blocks of
a fixed number of ids.  A block of 32-bit ids is transposed: plane k holds bit
(or byte) k of every id, and each plane is compressed by itself, which suits
it because the high planes hardly change.  Files are Parquet tables with one
row per block, so that Spark's commit protocol covers them: shard, block,
number of ids, compressed planes with their sizes, and the documents that
overlap the block.  The chunk index is a second, small table: the place of
each block among all ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from pitchlake.llm.tokens import Encoder

BLOCK_IDS = 1 << 16
LEVEL = 3
BLOCK_SCHEMA = ("shard int, block int, n_ids int, planes array<binary>, plane_bytes array<int>, "
                "docs array<struct<no:bigint,key:bigint,start:bigint,n:bigint>>")


def to_planes(ids: np.ndarray, mode: str = "byte") -> list[bytes]:
    """The compressed planes of a block of unsigned 32-bit ids, lowest first."""
    rows = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if mode == "bit":
        bits = np.unpackbits(rows, axis=1, bitorder="little")
        planes = [np.packbits(bits[:, k], bitorder="little") for k in range(32)]
    else:
        planes = [np.ascontiguousarray(rows[:, k]) for k in range(4)]
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    return [squeeze(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    """The ids of a block; 32 planes are bits, 4 are bytes."""
    grow = zstandard.ZstdDecompressor().decompress
    raw = [np.frombuffer(grow(p), dtype=np.uint8) for p in planes]
    if len(raw) == 32:
        bits = np.stack([np.unpackbits(p, count=n_ids, bitorder="little") for p in raw], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")
    return np.ascontiguousarray(np.stack(raw, axis=1)).reshape(-1).view("<u4")


def encode_blocks(docs: DataFrame, tokenizer: str, byte_level: bool, end_id: int, key: str = "doc_id",
                  text: str = "text", block_ids: int = BLOCK_IDS, mode: str = "byte") -> DataFrame:
    """Blocks of the ids of all documents, each document followed by ``end_id``, in ascending key order.

    A null or empty text is the end id alone.  A null key sorts first; repeated
    keys are documents of their own, in text order.  Only key and text are read;
    an empty table gives no block.  A task holds one Arrow batch of texts and
    one block, and a document may span any number of blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer, byte_level)
        end = np.array([end_id], dtype="<u4").tobytes()
        shard, no, at, block = TaskContext.get().partitionId(), 0, 0, 0
        held: list[bytes] = []
        size = 0
        over: list[dict] = []  # documents that overlap the ids held

        def cut(n: int) -> dict:
            nonlocal held, size, over, block
            data = b"".join(held)
            ids = np.frombuffer(data[:4 * n], dtype="<u4")
            planes = to_planes(ids, mode)
            first = block * block_ids
            row = {"shard": shard, "block": block, "n_ids": n, "planes": planes, "plane_bytes": [len(p) for p in planes],
                   "docs": [d for d in over if d["start"] < first + n]}
            block += 1
            over = [d for d in over if d["start"] + d["n"] > first + n]
            held, size = [data[4 * n:]], size - n
            return row

        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int32()), ("planes", pa.list_(pa.binary())),
                            ("plane_bytes", pa.list_(pa.int32())), ("docs", pa.list_(pa.struct(
                                [("no", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])))])
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(t.as_py()) + end
                n = len(ids) // 4
                over.append({"no": no, "key": k, "start": at, "n": n})
                held.append(ids)
                no, at, size = no + 1, at + n, size + n
                while size >= block_ids:
                    rows.append(cut(block_ids))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if size:
            yield pa.RecordBatch.from_pylist([cut(size)], schema=schema)

    ranged = docs.select(F.col(key).cast("long"), text).repartitionByRange(key).sortWithinPartitions(key, text)
    return ranged.mapInArrow(run, BLOCK_SCHEMA)


def write_files(blocks: DataFrame, path: str) -> None:
    """Write ``path``/blocks and, from them, the chunk index ``path``/index."""
    spark = blocks.sparkSession
    # Planes are compressed already.
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    kept = spark.read.schema(blocks.schema).parquet(f"{path}/blocks")
    # One row per shard (a task's range of documents), so this window is as small as the list of tasks.
    shards = (kept.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .withColumn("first", F.coalesce(F.sum("n").over(
                  Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    (kept.select("shard", "block", "n_ids", "plane_bytes", F.size("docs").alias("n_docs"))
     .join(shards.select("shard", F.col("first").alias("shard_start")), "shard")
     .write.parquet(f"{path}/index"))


def read_documents(spark, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Per document of the files: key, start (among all ids), n_tokens, ids_crc32.

    Blocks are decoded independently; a document over several blocks is the
    combination of its pieces' checksums.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    starts = spark.read.parquet(f"{path}/index").select("shard", "shard_start").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"]).astype("<u4", copy=False)
                first = row["block"] * block_ids
                for d in row["docs"]:
                    a, b = max(d["start"], first), min(d["start"] + d["n"], first + row["n_ids"])
                    out.append((row["shard"], d["no"], d["key"], d["start"], d["n"], a, b - a, zlib.crc32(ids[a - first:b - first].tobytes())))
            names = ["shard", "no", "key", "start", "n", "at", "length", "crc"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(
                zip(*out) if out else [()] * len(names))], names=names)

    pieces = blocks.select("shard", "block", "n_ids", "planes", "docs").mapInArrow(
        run, "shard int, no long, key long, start long, n long, at long, length long, crc long")
    docs = pieces.groupBy("shard", "no").agg(
        F.min("key").alias("key"), F.min("start").alias("start"), F.min("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("at", "length", "crc"))).alias("parts"))
    return (docs.join(starts, "shard").select(
        "key", (F.col("shard_start") + F.col("start")).alias("start"), F.col("n").alias("n_tokens"),
        combine_crc(F.col("parts.crc"), F.col("parts.length")).alias("ids_crc32")))


def crc32_of_two(a: int, b: int, b_bytes: int) -> int:
    """CRC-32 of two byte strings in a row from the CRC-32 of each (shift the first by zero bytes, then add)."""
    def times(m: list[int], v: int) -> int:
        out = i = 0
        while v:
            if v & 1:
                out ^= m[i]
            v >>= 1
            i += 1
        return out

    if not b_bytes:
        return a
    step = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(3):  # eight: one zero byte
        step = [times(step, v) for v in step]
    while b_bytes:
        if b_bytes & 1:
            a = times(step, a)
        step = [times(step, v) for v in step]
        b_bytes >>= 1
    return a ^ b


@pandas_udf(LongType())
def combine_crc(crcs, lengths):  # noqa: ANN001, ANN201  (pandas series of arrays)
    """The checksum of pieces in a row; lengths are in ids of four bytes."""
    import pandas as pd

    def one(c, n):  # noqa: ANN001, ANN202
        total = int(c[0])
        for x, m in zip(c[1:], n[1:]):
            total = crc32_of_two(total, int(x), 4 * int(m))
        return total

    return pd.Series([one(c, n) for c, n in zip(crcs, lengths)], dtype="int64")
