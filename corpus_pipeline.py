"""A corpus pipeline of operators of ``pitchlake.llm``: quality rules, near duplicates,
repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet below the shared checkpoint folder and rereads it as the next
stage's documents.  All but the last return the columns of ``documents``.
Documents with a null or empty text don't pass the quality rules; rows that
repeat a document are near duplicates, of which one stays; extra columns pass
through all stages but the last, whatever their names; an empty table gives
empty results.
"""

from __future__ import annotations

from functools import wraps
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import containment, genetic_packing, quality_cascade, simhash_pivots, suffix_arrays
from pitchlake.llm.common import prepare, written
from pitchlake.llm.queries import vocabulary


def set_apart(stage):  # noqa: ANN001, ANN201
    """The stage with input columns that begin with ``__`` under other names meanwhile: such names are the operators' own."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        free = (f"own{i}" for i in count() if f"own{i}" not in docs.columns)
        own = {c: next(free) for c in docs.columns if c.startswith("__")}
        out = stage(spark, docs.withColumnsRenamed(own), sf_dir)
        return out.withColumnsRenamed({new: c for c, new in own.items()})

    return run_stage


def numbered(docs: DataFrame) -> DataFrame:
    """``docs``, written, with a number of its own for every row (``__row``): ids may be null or repeat."""
    return written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered-documents")


@set_apart
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    prepare(spark)
    own = {c: f"__own_{c}" for c in (*quality_cascade.MEASURES, "rejected_by") if c in docs.columns}
    judged = quality_cascade.judge(docs.withColumnsRenamed(own))
    return judged.filter(F.col("rejected_by").isNull()).select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


@set_apart
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the one with the smallest id, of each group of near duplicates.

    Of rows that share the smallest id one stays, whatever their texts; a row
    without an id stays only where no row of its group has one.
    """
    prepare(spark)
    rows = numbered(docs)
    groups = simhash_pivots.near_duplicates(rows, key="__row").select(F.col("key").alias("__of"), "component")
    ids = rows.select("__row", F.col("doc_id").alias("__id"))
    order = F.struct(F.col("__id").isNull().alias("none"), "__id", "__row")
    first = (ids.join(groups, F.col("__row") == F.col("__of")).groupBy("component")
             .agg(F.min_by("__row", order).alias("__first")).select("__first"))
    return rows.join(first, F.col("__row") == F.col("__first"), "left_semi").select(*docs.columns)


@set_apart
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of 200-byte strings that stand anywhere else too."""
    prepare(spark)
    out = suffix_arrays.dedup_documents(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


@set_apart
def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    rows = numbered(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = containment.contained(rows, items, key="__row").select(F.col("key").alias("__leak")).distinct()
    return rows.join(found, F.col("__row") == F.col("__leak"), "left_anti").select(*docs.columns)


@set_apart
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 2048 tokens."""
    prepare(spark)
    packed = genetic_packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), True, end_id=0)
    return packed.select(F.col("key").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


# The quality rules, near duplicates, repeated passages, benchmark leaks and packing, in this order.
STAGES = [("quality rules", quality), ("near duplicates", near_duplicates),
          ("repeated passages", passages), ("benchmark leaks", leaks), ("packing", packing)]

# Fingerprints, suffix arrays and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
