"""Bronze as a Structured Streaming job: newly landed files flow into the bronze
table by keyed upsert.

``readStream`` over the landing tree (file source; it remembers which files
it has processed in the checkpoint), ``foreachBatch`` upserts each
micro-batch, ``trigger(availableNow=True)`` processes what has landed and
stops.  A re-landed day arrives as new files, so its rows update the
existing keys (late or corrected data).  Within one micro-batch a key can
occur twice (a day landed twice before the run); the row from the newest
file wins.  The table remembers the last batch of each stream (by its checkpoint),
so a batch that is played again after a lost driver is skipped.  No watermark is needed: there is no event-time state, the key
makes the result exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.operators.incremental import with_audit
from pitchlake.schemas import LANDING_PARTITION_SCHEMA
from pitchlake.sinks.layout import Layout
from pitchlake.sources.local import nan_to_null


def newest_per_key(batch: DataFrame, keys: Sequence[str], order_col: str = "__file_time") -> DataFrame:
    """One row per key: the row with the greatest ``order_col`` (ties: the greatest file path)."""
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc(), F.col("__file_path").desc())
    return batch.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).drop("__rank")


def stream_bronze(spark: SparkSession, landing_root: str, data_schema: T.StructType, layout: Layout,
                  table: str, keys: Sequence[str], checkpoint: str, partition_by: str | None = None,
                  day_of: str | None = None, audit_col: str | None = "processed_timestamp", max_files_per_trigger: int | None = None) -> None:
    """Run the landing -> bronze stream until everything landed so far is processed.

    With ``partition_by`` a batch rewrites only the partitions it touches; with
    ``day_of`` that column is derived as the day of ``day_of``.  The batch is
    computed once (``Layout.upsert`` stages it).
    """
    fields = [f for f in data_schema.fields if f.name not in LANDING_PARTITION_SCHEMA.fieldNames()]
    schema = T.StructType(fields + list(LANDING_PARTITION_SCHEMA.fields))
    reader = spark.readStream.schema(schema).option("basePath", landing_root)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_root).select(
        "*", F.col("_metadata.file_modification_time").alias("__file_time"),
        F.col("_metadata.file_path").alias("__file_path"))

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        rows = newest_per_key(nan_to_null(batch), keys).drop("__file_time", "__file_path")
        if day_of:
            rows = rows.withColumn(partition_by, F.to_date(F.col(day_of)))
        if audit_col:
            rows = with_audit(rows, audit_col)
        layout.upsert(table, rows, keys, partition_by=partition_by, batch=(checkpoint, batch_id))

    query = (stream.writeStream.foreachBatch(upsert_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
