"""Bronze layer: landed pitches and the person register, stamped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.operators.incremental import with_audit
from pitchlake.sources.landing import read_landing
from pitchlake.sources.local import nan_to_null
from pitchlake.sources.lookup import read_lookup_csv, with_source_file
from pitchlake.schemas import LANDING_PARTITION_SCHEMA, RAW_PITCH_SCHEMA


class MissingColumnsError(ValueError):
    """Landed rows without a column that the later layers read."""


def bronze_pitches(landed: DataFrame) -> DataFrame:
    """Landed pitch rows, all columns but the folder names: the raw columns in their declared
    types, NaN measures turned into NULL, stamped with ``processed_timestamp``."""
    missing = sorted(set(RAW_PITCH_SCHEMA.names) - set(landed.columns))
    if missing:
        raise MissingColumnsError(f"landed rows lack {missing}")
    declared = {f.name: f.dataType for f in RAW_PITCH_SCHEMA.fields}
    typed = landed.select(*[F.col(c).cast(declared[c]).alias(c) if c in declared else F.col(c) for c in landed.columns
                           if c not in LANDING_PARTITION_SCHEMA.names])
    return with_audit(nan_to_null(typed), "processed_timestamp")


def read_bronze_source(spark: SparkSession, landing_root: str, start=None, end=None) -> DataFrame:
    """Landed pitches of ``[start, end]`` (all days when both are None), every landed column."""
    return read_landing(spark, landing_root, None, start, end, date_col="game_date")


def bronze_players(spark: SparkSession, glob: str) -> DataFrame:
    """Register CSV files, stamped with ``ingestion_timestamp`` and the source file path."""
    return with_source_file(with_audit(read_lookup_csv(spark, glob), "ingestion_timestamp"))
