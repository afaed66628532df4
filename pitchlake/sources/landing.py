"""Landing tree (Hive-style ``y=YYYY/m=MM/d=DD`` Parquet) and date-range scans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.schemas import LANDING_PARTITION_SCHEMA
from pitchlake.sinks.files import list_folders
from pitchlake.sources.drift import merged, recorded

PARTITION_COLUMNS: tuple[str, ...] = ("y", "m", "d")
DateLike = str | dt.date


def day_folders(spark: SparkSession, root: str, start: DateLike | None = None,
                end: DateLike | None = None) -> list[tuple[dt.date, str]]:
    """(day, path) of every day folder of ``[start, end]``, in order.  Only years and months of the range are listed."""
    lo, hi = (dt.date.fromisoformat(str(x)[:10]) if x is not None else None for x in (start, end))

    def inside(*parts: int) -> bool:
        def cut(x: dt.date) -> tuple[int, ...]:
            return (x.year, x.month, x.day)[:len(parts)]
        return (lo is None or parts >= cut(lo)) and (hi is None or parts <= cut(hi))

    def below(path: str, letter: str) -> list[tuple[int, str]]:
        names = [n for n in list_folders(spark, path) if n.startswith(f"{letter}=") and n[2:].isdigit()]
        return [(int(n[2:]), f"{path}/{n}") for n in names]

    found = [(dt.date(y, m, d), day) for y, year in below(root.rstrip("/"), "y") if inside(y)
             for m, month in below(year, "m") if inside(y, m) for d, day in below(month, "d") if inside(y, m, d)]
    return sorted(found)


def read_landing(spark: SparkSession, root: str, schema: T.StructType | None = None,
                 start: DateLike | None = None, end: DateLike | None = None,
                 date_col: str | None = None) -> DataFrame:
    """Scan a landing tree with ``y``, ``m``, ``d`` kept as strings.

    Partition inference would turn ``m=03`` into 3 (and a write-back would
    create ``m=3`` beside ``m=03``), so the partition columns are declared as
    strings.  Without ``schema`` the data columns come from the schemas
    recorded at writing, merged (``sources.drift``); only a tree that has no records,
    as it was written elsewhere, has the Parquet footers of all its days read.  With ``start``/``end`` only the day folders of the range
    are given to the scan and, when ``date_col`` is given, the date column is
    filtered as well.  A range without a landed day gives no rows.
    """
    paths = [root]
    if start is not None or end is not None:
        paths = [p for _, p in day_folders(spark, root, start, end)]
    records = recorded(spark, root) if schema is None else []
    if records:
        schema = merged(records)
    elif schema is None:
        inferred = spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*(paths or [root])).schema
        schema = T.StructType([f for f in inferred.fields if f.name not in PARTITION_COLUMNS])
    data_fields = [f for f in schema.fields if f.name not in PARTITION_COLUMNS]
    full = T.StructType(data_fields + list(LANDING_PARTITION_SCHEMA.fields))
    if not paths:
        return spark.createDataFrame([], full)
    df = spark.read.schema(full).option("basePath", root).parquet(*paths)
    if date_col is not None:
        df = date_range(df, date_col, start, end)
    return df


def tree_range(spark: SparkSession, root: str, start: DateLike | None = None, end: DateLike | None = None,
               log: DataFrame | None = None) -> DataFrame:
    """One row: first and last day of ``[start, end]`` that holds a row, and whether any does (``has_new``).

    Days come from folder names, less those that the ingest log says are
    empty; whether a day holds a row from one row at most, read from its end of the
    range inwards.  No rows are counted, and days between are not opened.
    """
    days = day_folders(spark, root, start, end)
    if log is not None:
        # The last entry of a day counts.
        last = log.groupBy("day").agg(F.max_by("n_rows", "logged_at").alias("n"))
        empty = {r[0] for r in last.filter(F.col("n") == 0).collect()}
        days = [(d, p) for d, p in days if d not in empty]

    def first(found: list[tuple[dt.date, str]]) -> dt.date | None:
        return next((d for d, p in found if spark.read.schema("__any int").parquet(p).limit(1).count()), None)

    lo = first(days)
    hi = first(days[::-1]) if lo is not None else None
    return spark.createDataFrame([(lo, hi, lo is not None)], "start_date date, end_date date, has_new boolean")


def partition_date(y: str = "y", m: str = "m", d: str = "d") -> Column:
    """The day a landing partition holds, as a date."""
    return F.make_date(F.col(y).cast("int"), F.col(m).cast("int"), F.col(d).cast("int"))


def _between(c: Column, start: DateLike | None, end: DateLike | None) -> Column:
    conds = []
    if start is not None:
        conds.append(c >= F.lit(start).cast("date"))
    if end is not None:
        conds.append(c <= F.lit(end).cast("date"))
    out = conds[0]
    for x in conds[1:]:
        out = out & x
    return out


def date_range(df: DataFrame, col: str | None, start: DateLike | None, end: DateLike | None) -> DataFrame:
    """Rows whose day lies in the inclusive range ``[start, end]``.

    The column is compared as a date (a timestamp late on ``end`` is kept).
    When the frame has landing partition columns the same range is applied
    to them too, which turns into a partition filter: no file outside the range
    is opened (the folders were listed when the frame was made).
    """
    if start is None and end is None:
        return df
    if all(p in df.columns for p in PARTITION_COLUMNS):
        df = df.filter(_between(partition_date(), start, end))
    if col is not None:
        df = df.filter(_between(F.to_date(F.col(col)), start, end))
    return df
