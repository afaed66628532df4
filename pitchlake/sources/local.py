"""Driver-local frames (e.g. one fetched day) into a distributed table."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_local(spark: SparkSession, pdf: pd.DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """``createDataFrame`` through Arrow, with NaN turned into NULL in floating columns.

    Only for small frames that already sit on the driver (one fetched day);
    bulk data is read from files.  pandas marks missing numbers as NaN,
    which would pass ``isNotNull`` and poison averages, so NaN is normalised
    to NULL once here.
    """
    df = spark.createDataFrame(pdf, schema=schema) if schema is not None else spark.createDataFrame(pdf)
    return nan_to_null(df)


# Rows that go to Spark at a time.
BATCH_ROWS = 50_000


def from_local_batches(spark: SparkSession, batches: Iterable[pa.RecordBatch], path: str, schema: T.StructType) -> DataFrame:
    """Local record batches as a table at ``path``: each is appended as Parquet in parts of ``BATCH_ROWS`` rows.

    ``batches`` may be a generator (a fetch page by page): the driver holds one
    batch at a time, never the whole frame.  NaN becomes NULL; columns are taken by
    name and cast to ``schema``.  No batch gives an empty table.
    """
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            rows = spark.createDataFrame(pa.Table.from_batches([batch.slice(at, BATCH_ROWS)]))
            rows = nan_to_null(rows).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
            rows.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float/double column."""
    fixes = {f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
             for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(fixes) if fixes else df
