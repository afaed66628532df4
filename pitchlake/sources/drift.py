"""Schemas of a landing tree whose days gain columns and widen types.

Every write leaves a record of its schema beside the days (one small file per
distinct schema); the tree is read with the records merged, so no footer of any
day is opened to learn the columns.  Files with narrower types or without a
column are read as they are: Spark's Parquet reader widens them, and a missing
column is NULL.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pitchlake.sinks.files import file_system, list_files, path_exists, read_text, write_text

RECORDS = "_schemas"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class DriftError(ValueError):
    """Two types of a column that no type holds both of."""


def wider(a: T.DataType, b: T.DataType, column: str = "") -> T.DataType:
    """The type that holds the values of both, among those that Parquet files of the narrower one can be read as."""
    if a == b:
        return a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.NullType):
            return y
        if isinstance(x, T.DoubleType) and isinstance(y, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType)):
            return x
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    raise DriftError(f"column {column}: {a.simpleString()} and {b.simpleString()}")


def merged(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns, in the order in which they first come, with the widest types."""

    def two(a: T.StructType, b: T.StructType) -> T.StructType:
        kinds = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            kinds[f.name] = wider(kinds[f.name], f.dataType, f.name) if f.name in kinds else f.dataType
        return T.StructType([T.StructField(n, k, True) for n, k in kinds.items()])

    return reduce(two, schemas, T.StructType([]))


def record_schema(df: DataFrame, root: str) -> None:
    """Leave the schema of ``df`` beside the tree, once per distinct schema; raises ``DriftError`` if it can't be merged."""
    spark, folder = df.sparkSession, f"{root.rstrip('/')}/{RECORDS}"
    text = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields]).json()
    path = f"{folder}/{hashlib.md5(text.encode()).hexdigest()}.json"
    if not path_exists(spark, path):
        merged([*recorded(spark, root), df.schema])
        files, p = file_system(spark, folder)
        files.mkdirs(p)
        # Records are read in the order of their numbers.
        write_text(spark, path, json.dumps({"number": len(list_files(spark, folder)), "schema": text}))


def recorded(spark: SparkSession, root: str) -> list[T.StructType]:
    """The recorded schemas, oldest first; none for a tree that was written elsewhere."""
    folder = f"{root.rstrip('/')}/{RECORDS}"
    found = [json.loads(read_text(spark, f"{folder}/{n}")) for n in list_files(spark, folder) if n.endswith(".json")]
    return [T.StructType.fromJson(json.loads(r["schema"])) for r in sorted(found, key=lambda r: (r["number"], r["schema"]))]
