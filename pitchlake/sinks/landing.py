"""Writing the landing tree and the ingest log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.sinks.files import path_exists
from pitchlake.sources.drift import record_schema
from pitchlake.sources.landing import PARTITION_COLUMNS, day_folders

INGEST_LOG_SCHEMA = T.StructType([
    T.StructField("day", T.DateType(), False),
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("logged_at", T.TimestampType(), True),
])


def landing_partitions(date: Column) -> dict[str, Column]:
    """``y`` = 4-digit year, ``m`` and ``d`` zero-padded to 2 digits, all strings."""
    return {
        "y": F.format_string("%04d", F.year(date)),
        "m": F.format_string("%02d", F.month(date)),
        "d": F.format_string("%02d", F.dayofmonth(date)),
    }


def write_landing(df: DataFrame, root: str, date_col: str, mode: str = "dynamic",
                  max_records_per_file: int = 5_000_000, observe: tuple[Observation, list[Column]] | None = None) -> None:
    """Write rows partitioned by ``y/m/d`` derived from ``date_col``.

    ``mode="dynamic"`` replaces only the days present in ``df`` (a re-landed
    day, or a backfill range, leaves other days alone); ``"overwrite"``
    replaces the whole tree; ``"append"`` adds files.  The partition values
    live in the path only.  Rows are rebalanced by day before writing, which
    keeps few files per day while AQE splits an oversized day over several
    tasks.  The schema is recorded beside the tree (``sources.drift``).
    ``observe`` counts on the rows as the writing tasks see them.
    """
    record_schema(df, root)
    out = df.withColumns(landing_partitions(F.to_date(F.col(date_col))))
    out = out.hint("rebalance", *PARTITION_COLUMNS)
    if observe is not None:
        # Above the rebalance, so that each row counts in the task that writes it, and only in the attempt that is kept.
        out = out.observe(observe[0], *observe[1])
    writer = out.write.partitionBy(*PARTITION_COLUMNS).option("maxRecordsPerFile", max_records_per_file)
    if mode == "dynamic":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode in ("overwrite", "append"):
        writer = writer.mode(mode).option("partitionOverwriteMode", "static")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    writer.parquet(root)


def log_days(spark: SparkSession, log_path: str, days: DataFrame, day_col: str = "day",
             n_rows_col: str | None = None) -> None:
    """Append fetched days to the ingest log (``n_rows`` 0 marks a day that had no data),
    so a later run does not fetch them again."""
    n_rows = F.col(n_rows_col).cast("long") if n_rows_col else F.lit(0).cast("long")
    (days.select(F.to_date(F.col(day_col)).alias("day"), n_rows.alias("n_rows"),
                 F.current_timestamp().alias("logged_at"))
     .write.mode("append").parquet(log_path))


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The ingest log; empty when nothing was logged yet."""
    if not path_exists(spark, log_path):
        return spark.createDataFrame([], INGEST_LOG_SCHEMA)
    return spark.read.schema(INGEST_LOG_SCHEMA).parquet(log_path)


def landed_days(spark: SparkSession, root: str) -> DataFrame:
    """The days of a landing tree, column ``day``, from its folder names: no file is opened."""
    return spark.createDataFrame([(d,) for d, _ in day_folders(spark, root)], "day date")


def land_days(spark: SparkSession, rows: DataFrame, root: str, log_path: str, days: DataFrame,
              date_col: str, day_col: str = "day") -> None:
    """Land fetched rows and log every requested day with its row count.

    ``rows`` holds what was fetched for the requested ``days``: their days are
    replaced in the landing tree (dynamic overwrite).  Rows are counted while they
    are written, with a counter per requested day: no landed file is opened.  A requested day without
    a row is logged with ``n_rows = 0``, so that ``missing_days`` does not ask
    for it again.
    """
    wanted = sorted({r[0] for r in days.select(F.to_date(F.col(day_col)).alias("day")).collect() if r[0] is not None})  # days of the calendar
    if not wanted:
        return
    counts, day = Observation(), F.to_date(F.col(date_col))
    write_landing(rows, root, date_col, mode="dynamic",
                  observe=(counts, [F.count_if(day == F.lit(d)).alias(d.isoformat()) for d in wanted]))
    n = counts.get
    log_days(spark, log_path, spark.createDataFrame([(d, n[d.isoformat()]) for d in wanted], "day date, n_rows long"), n_rows_col="n_rows")
