"""Layer jobs over a ``Layout``: the full load and the daily increment share the
same DataFrame functions; only the source range and the sink differ."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.operators.incremental import landed_range, latest_date, missing_days, run_if_new
from pitchlake.plans import bronze, gold, silver
from pitchlake.schemas import PITCH_KEYS, PLAYER_SCHEMA
from pitchlake.sinks.landing import land_days, landed_days, read_log
from pitchlake.sinks.layout import Layout
from pitchlake.sinks.ranges import one_of
from pitchlake.sources.landing import date_range

# Table names.
BRONZE = "bronze_statcast"
PLAYERS_BRONZE = "bronze_player_name"
PLAYERS = "silver_player_name"
SILVER = "silver_statcast_base"
ENRICHED = "silver_statcast_enrich"
GAMES = "gold_game_summary_stats"
PITCHERS = "gold_pitcher_yearly"
# Parts of the yearly table by day, which add up to it.
PITCHER_DAYS = "gold_pitcher_days"
# Which days hold rows of a game: (game_pk, day), so that a change of a game reads those days only.
GAME_DAYS = "index_game_days"
AFFECTED = "index_affected_days"
# Games of the affected days that also have rows outside of them.
OPEN_GAMES = "index_open_games"
# People whose register row changed with the last load.
CHANGED_PEOPLE = "index_changed_people"


def load_players(spark: SparkSession, layout: Layout, glob: str) -> DataFrame:
    """Register CSV -> bronze (overwrite) -> silver player names (overwrite)."""
    layout.write(PLAYERS_BRONZE, bronze.bronze_players(spark, glob))
    layout.write(PLAYERS, silver.silver_players(layout.read(PLAYERS_BRONZE)), schema=PLAYER_SCHEMA)
    return layout.read(PLAYERS)


def _row_hashes(players: DataFrame) -> DataFrame:
    """(player_id, h): a hash of what the enrichment reads of a person."""
    return players.filter(F.col("player_id").isNotNull()).select(
        "player_id", F.sha2(F.to_json(F.struct("player_name", "is_current")), 256).alias("h"))


def refresh_players(spark: SparkSession, layout: Layout, glob: str) -> DataFrame:
    """Load the register again; returns the ids of people who are new, gone or read differently than before."""
    before = _row_hashes(layout.read(PLAYERS)).withColumnRenamed("h", "old")  # the last version stays readable
    after = _row_hashes(load_players(spark, layout, glob))
    changed = before.join(after, "player_id", "full").filter(~F.col("h").eqNullSafe(F.col("old"))).select("player_id")
    layout.write(CHANGED_PEOPLE, changed)
    return layout.read(CHANGED_PEOPLE)


def reenrich(spark: SparkSession, layout: Layout) -> bool:
    """Give the games of people changed by ``refresh_players`` their new names, in every layer that holds names.

    Only ids of silver are read to find these games; then their days. The tables equal
    a full load with the new register.  Returns False (and writes nothing) if nobody changed or played.
    """
    people = layout.read(CHANGED_PEOPLE)
    if not people.limit(1).count():
        return False
    seen = layout.read(SILVER).select("game_pk", F.to_date("date").alias("day"),
                                      F.explode(F.array(F.col("batter").cast("long"), F.col("pitcher").cast("long"))).alias("player_id"))
    # The days of whole games: a game over two days is replaced whole.
    games = seen.join(people, on="player_id", how="left_semi").select("game_pk").distinct()
    layout.write(AFFECTED, layout.read(GAME_DAYS).join(games, on="game_pk", how="left_semi"))
    affected = layout.read(AFFECTED)
    days = affected.select("day").distinct()
    listed = [r[0] for r in days.collect()]  # days of the calendar
    if not listed:
        return False
    # Their days are written anew, all games of them: other rows read the same people as before.
    _enrich_days(layout, listed)
    _refresh_pitchers(layout, listed)
    return True


def _enrich_days(layout: Layout, listed: list[dt.date | None]) -> None:
    """The enriched rows of whole days, from silver."""
    rows = layout.read(SILVER).filter(one_of("date", listed))
    layout.rewrite(ENRICHED, silver.enrich_by_day(rows, layout.read(PLAYERS)), "date", listed, gathered=True)


def _day_parts(enriched: DataFrame) -> DataFrame:
    return gold.pitcher_parts(enriched, ("date", *gold.PITCHER_KEYS))


def _refresh_pitchers(layout: Layout, listed: list[dt.date | None]) -> None:
    """The yearly table after a change of days: their parts are made again, and the seasons added up from parts."""
    layout.rewrite(PITCHER_DAYS, _day_parts(layout.read(ENRICHED).filter(one_of("date", listed))), "date", listed)
    years = list({d and d.year for d in listed})
    parts = layout.read(PITCHER_DAYS)
    parts = parts.withColumn("__year", F.year("date")).filter(one_of("__year", years))
    layout.rewrite(PITCHERS, gold.with_rates(gold.merged_parts(parts)), "season", years)


def _game_days(rows: DataFrame, col: str) -> DataFrame:
    return rows.select("game_pk", F.to_date(F.col(col)).alias("day")).distinct()


def _games(enriched: DataFrame) -> DataFrame:
    """The game summary with the season it is stored under."""
    return gold.game_summary(enriched).withColumn("season", F.year("date"))


def full_load(spark: SparkSession, layout: Layout, landed: DataFrame) -> None:
    """Every layer rebuilt from all landed rows (each a full overwrite)."""
    layout.write(BRONZE, bronze.bronze_pitches(landed), partition_by="game_date", gathered=True)  # landed by day
    layout.write(GAME_DAYS, _game_days(layout.read(BRONZE), "game_date"))
    layout.write(SILVER, silver.silver_base(layout.read(BRONZE), by_day=True), partition_by="date", gathered=True)
    layout.write(ENRICHED, silver.enrich_by_day(layout.read(SILVER), layout.read(PLAYERS)), partition_by="date", gathered=True)
    enriched = layout.read(ENRICHED)
    layout.write(GAMES, _games(enriched), partition_by="season")
    layout.write(PITCHER_DAYS, _day_parts(enriched), partition_by="date")
    layout.write(PITCHERS, gold.with_rates(gold.merged_parts(layout.read(PITCHER_DAYS))), partition_by="season")


def incremental_run(spark: SparkSession, layout: Layout, landed: DataFrame,
                    start: dt.date | str, end: dt.date | str) -> bool:
    """Apply the landed rows of ``[start, end]`` to every layer; the tables then equal a full load.

    Silver numbers pitches per game and gold aggregates per game and per
    season, so the days that hold rows of affected games (also those of other
    ranges) are computed anew, all games of them, and written in the place of the old
    ones, without a search for old rows.  Rows of a game that is not affected but has rows outside
    these days stay as they are.  Affected seasons,
    before and after the change, are added up from parts by day, of which only
    those of touched days are made again.  Only days that hold rows
    of affected games are read (by partition).  Returns False (and writes
    nothing) when no row landed in the range.  For a changed register see
    ``refresh_players`` and ``reenrich``.
    """
    new = date_range(landed, "game_date", start, end)
    rng = landed_range(new, "game_date").first()

    def apply(lo: dt.date, hi: dt.date) -> bool:
        games = new.select("game_pk").distinct()
        layout.write(AFFECTED, _game_days(new, "game_date").union(
            layout.read(GAME_DAYS).join(games, on="game_pk", how="left_semi")).distinct())
        affected = layout.read(AFFECTED)
        games, days = affected.select("game_pk").distinct(), affected.select("day").distinct()
        listed = [r[0] for r in days.collect()]  # days of the calendar
        seasons = days.select(F.year("day").alias("season")).distinct()

        layout.upsert(BRONZE, bronze.bronze_pitches(new), PITCH_KEYS, partition_by="game_date", old_values=days, gathered=True)  # landed by day
        layout.replace(GAME_DAYS, _game_days(layout.read(BRONZE).filter(one_of("game_date", listed)).join(
            games, on="game_pk", how="left_semi"), "game_date"), games)

        # Games of these days that also have rows outside: their numbers and summaries don't follow from these days.
        here = one_of("day", listed)
        inside = layout.read(GAME_DAYS).filter(here).select("game_pk").distinct()
        layout.write(OPEN_GAMES, layout.read(GAME_DAYS).filter(~here).join(inside, on="game_pk", how="left_semi").select("game_pk").distinct())
        some_open = not layout.read(OPEN_GAMES).isEmpty()

        def closed(rows: DataFrame) -> DataFrame:
            known = rows.filter(F.col("game_pk").isNotNull())
            return known.join(layout.read(OPEN_GAMES), on="game_pk", how="left_anti") if some_open else known

        def of_days(name: str, col: str = "date") -> DataFrame:
            return layout.read(name).filter(one_of(col, listed))

        numbered = silver.silver_base(closed(of_days(BRONZE, "game_date")), by_day=True)
        stay = of_days(SILVER)
        unknown = stay.filter(F.col("game_pk").isNull())
        stay = unknown.unionByName(stay.join(layout.read(OPEN_GAMES), on="game_pk", how="left_semi")) if some_open else unknown
        layout.rewrite(SILVER, numbered.unionByName(stay), "date", listed, gathered=True)
        _enrich_days(layout, listed)
        changed = closed(inside.union(games).distinct())
        layout.replace(GAMES, _games(closed(of_days(ENRICHED))), changed, "season", old_values=seasons)
        _refresh_pitchers(layout, listed)
        return True

    return bool(run_if_new(rng, apply))


def ingest(spark: SparkSession, root: str, log_path: str, fetch, end: dt.date, date_col: str,  # noqa: ANN001
           default: str | dt.date | None = None) -> DataFrame:
    """Fetch and land the days from the high-water mark to ``end`` that are neither landed nor logged.

    ``fetch(days)`` takes a frame of days and returns their rows; returns the days asked for.
    """
    have = landed_days(spark, root).union(read_log(spark, log_path).select("day")).distinct()
    last = latest_date(have, "day", *([default] if default is not None else []))
    first = have.agg(F.min("day")).first()[0] or last + dt.timedelta(days=1)
    days = missing_days(have, min(first, last + dt.timedelta(days=1)), end, "day")
    asked = [(r[0],) for r in days.collect()]
    days = spark.createDataFrame(asked, "day date")
    if asked:
        land_days(spark, fetch(days), root, log_path, days, date_col)
    return days
