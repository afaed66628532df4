"""Person register files (CSV with a header row, every column a string)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.schemas import LOOKUP_SCHEMA


def read_lookup_csv(spark: SparkSession, glob: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a glob of CSV files with a header row; no type inference.

    With ``schema`` (all strings) the header names must match it; without one
    every header column is read as a string.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(glob)


def with_source_file(df: DataFrame, out: str = "source_file") -> DataFrame:
    """Add the path of the file each row was read from (file-source metadata column)."""
    return df.select("*", F.col("_metadata.file_path").alias(out))


def write_lookup_csv(df: DataFrame, path: str) -> None:
    """Write a register as CSV with a header, whitespace kept as is."""
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
