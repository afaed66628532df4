"""Silver layer: cleaned, converted, labelled and numbered pitches; player names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.labels import label, resolve_sides
from pitchlake.functions.units import convert_units
from pitchlake.operators.lookup_join import fits_in_memory, resolve_names
from pitchlake.operators.sequence import DEFAULT_ROWS_PER_BUCKET, deal, sequence_index
from pitchlake.schemas import (
    GAME_TYPE_LABELS,
    LAUNCH_SPEED_ANGLE_LABELS,
    NON_COMPETITIVE_GAME_TYPES,
    PASS_THROUGH_COLUMNS,
    RENAMES,
    UNIT_SPECS,
    ZONE_LABELS,
)


def competitive_only(df: DataFrame, col: str = "game_type",
                     excluded: tuple[str, ...] = NON_COMPETITIVE_GAME_TYPES) -> DataFrame:
    """Drop spring-training and exhibition games.  A NULL game type is dropped too
    (``NOT IN`` is unknown for NULL), as the source pipeline's ``!=`` tests do."""
    return df.filter(~F.col(col).isin(*excluded))


def code_labels(game_type_labels: Mapping[str, str] = GAME_TYPE_LABELS) -> list[Column]:
    """``game_type``, ``launch_speed_angle`` and ``pitch_zone_catcher_view`` labels."""
    return [
        label("game_type", game_type_labels).alias("game_type"),
        label("launch_speed_angle", LAUNCH_SPEED_ANGLE_LABELS).alias("launch_speed_angle"),
        label("zone", ZONE_LABELS).alias("pitch_zone_catcher_view"),
    ]


def renamed_columns() -> list[Column]:
    """Renames and the two casting renames (``try_cast``: bad input gives NULL, not an error)."""
    cols = [F.col(src).alias(dst) for src, dst in RENAMES.items()]
    cols.append(F.col("spin_axis").try_cast("int").alias("spin_axis_degree"))
    cols.append(F.col("arm_angle").try_cast("double").alias("pitch_arm_angle"))
    return cols


def silver_projection(df: DataFrame, game_type_labels: Mapping[str, str] = GAME_TYPE_LABELS) -> DataFrame:
    """The 72 silver columns (narrow: no shuffle).  ``processed_timestamp`` is kept when present."""
    passthrough = [c for c in PASS_THROUGH_COLUMNS if c != "processed_timestamp" or c in df.columns]
    cols: list[Column] = [F.col("game_pk"), F.to_date(F.col("game_date")).alias("date")]
    cols += [F.col(c) for c in passthrough[1:]]
    cols += convert_units(UNIT_SPECS)
    cols += code_labels(game_type_labels)
    cols += resolve_sides()
    cols += renamed_columns()
    return df.select(*cols)


def silver_base(df: DataFrame, game_type_labels: Mapping[str, str] = GAME_TYPE_LABELS,
                rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, index: bool = True,
                sizes_from: DataFrame | None = None, by_day: bool = False) -> DataFrame:
    """Bronze pitches -> silver pitches: filter, project, and number pitches per game.

    ``idx_game_pitch`` counts the pitches of a game by at-bat then pitch
    number.  It is numbered over the rows given, so an incremental run must
    pass whole games (see ``plans.runner``).  ``index=False`` leaves it out
    (for jobs that compute gold straight from bronze and never read it, which
    saves the count and the shuffle by game).  ``sizes_from``: a cheaper frame
    with ``game_pk`` for a superset of the rows (see ``sequence_index``).  ``by_day``:
    the rows of a day come in few tasks, for a write partitioned by ``date``.
    """
    projected = silver_projection(competitive_only(df), game_type_labels)
    if not index:
        return projected
    return sequence_index(projected, ("game_pk",), ("at_bat_number", "pitch_number"), "idx_game_pitch",
                          rows_per_bucket=rows_per_bucket, sizes_from=sizes_from, near="date" if by_day else None)


def silver_players(df: DataFrame, id_col: str = "key_mlbam", first: str = "name_first",
                   last: str = "name_last", effective_date: Column | None = None) -> DataFrame:
    """Person register -> one row per ``player_id`` with a display name.

    Rows without an id are dropped; the id text is read as a long, any
    fractional part cut off ('12.0' -> 12, text that is no number -> NULL); the
    name is ``trim(first) + ' ' + trim(last)`` skipping NULL parts (both NULL
    gives ''); slowly-changing-dimension columns mark every row current.
    Duplicate ids are reduced to one row (the greatest (ingestion time,
    source file, name)) so a lookup join can never multiply fact rows; the
    reduction is an aggregation, combined map-side for hot ids.
    """
    has_ts = "ingestion_timestamp" in df.columns
    has_src = "source_file" in df.columns
    rows = df.filter(F.col(id_col).isNotNull()).select(
        F.split_part(F.col(id_col), F.lit("."), F.lit(1)).try_cast("long").alias("player_id"),
        F.concat_ws(" ", F.trim(F.col(first)), F.trim(F.col(last))).alias("player_name"),
        (F.col("ingestion_timestamp") if has_ts else F.lit(None).cast("timestamp")).alias("ingestion_timestamp"),
        (F.col("source_file") if has_src else F.lit(None).cast("string")).alias("source_file"),
    )
    best = rows.groupBy("player_id").agg(
        F.max(F.struct("ingestion_timestamp", "source_file", "player_name")).alias("__best"))
    return best.select(
        "player_id",
        F.col("__best.player_name").alias("player_name"),
        F.col("__best.ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("__best.source_file").alias("source_file"),
        *scd2_columns(effective_date),
    )


def scd2_columns(effective_date: Column | None = None) -> list[Column]:
    """``effective_date`` (today unless given), ``end_date`` NULL, ``is_current`` true."""
    eff = effective_date if effective_date is not None else F.current_date()
    return [eff.alias("effective_date"), F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current")]


def enrich(silver: DataFrame, players: DataFrame, keep_ids: bool = False, broadcast: bool = False) -> DataFrame:
    """Replace ``batter`` and ``pitcher`` ids by player names (left joins; fielders stay ids).

    Only current register rows are used.
    """
    current = players.filter(F.col("is_current")) if "is_current" in players.columns else players
    return resolve_names(silver, current, {"batter": "batter", "pitcher": "pitcher"}, keep_ids=keep_ids,
                         spread_on=("game_pk", "at_bat_number", "pitch_number"), broadcast=broadcast)


def enrich_by_day(silver: DataFrame, players: DataFrame) -> DataFrame:
    """``enrich`` of stored, numbered rows (a game and number once each) with the rows of a day in few tasks.

    A stored register that fits in memory goes to the tasks that scan the days, and no pitch is
    shuffled.  Of a larger one, names are looked up for ids and keys alone; then they meet
    the wide rows, which are shuffled once, by day, and not sorted.
    """
    if fits_in_memory(players):
        return enrich(silver, players, broadcast=True)
    keys, roles = ["game_pk", "idx_game_pitch"], ["batter", "pitcher"]
    ids = silver.select("date", *keys, "at_bat_number", "pitch_number", *roles)
    dealt = deal(silver, "date", F.col("date"), keys)
    named = (enrich(ids, players).select(dealt.alias("__deal"), *[F.col(k).alias(f"__{k}") for k in keys], *[F.col(r).alias(f"__{r}") for r in roles])
             .repartition("__deal").hint("shuffle_hash").alias("n"))
    wide = silver.withColumn("__deal", dealt).repartition("__deal").alias("w")
    same = F.col("w.__deal") == F.col("n.__deal")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return wide.join(named, same).select(*[F.col(f"__{c}").alias(c) if c in roles else F.col(c) for c in silver.columns])
