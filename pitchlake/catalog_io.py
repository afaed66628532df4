"""Query catalogue, part 2: sources, sinks, incremental bookkeeping, upserts and
the streaming bronze job.  Each query writes what it needs below the shared
scratch folder (``spark.checkpoint.dir``), reads it back with the library's
readers, and returns a DataFrame over the written data."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake import catalog
from pitchlake.catalog import register, with_ctes
from pitchlake.operators import incremental
from pitchlake.session import scratch_path
from pitchlake.plans import runner
from pitchlake.plans.bronze import read_bronze_source
from pitchlake.schemas import PITCH_KEYS
from pitchlake.sinks.landing import landed_days, log_days, read_log, write_landing
from pitchlake.sinks.layout import Layout
from pitchlake.sinks.upsert import merge_rows
from pitchlake.sources import fixtures
from pitchlake.sources.landing import read_landing, tree_range
from pitchlake.sources.local import from_local_batches, nan_to_null
from pitchlake.sources.lookup import read_lookup_csv, with_source_file, write_lookup_csv
from pitchlake.streaming.bronze_stream import stream_bronze

# Fixed values of the IO queries.
RANGE_START, RANGE_END = "2024-01-10", "2024-01-20"   # inside the 30 days of `events`
UPSERT_TARGET_BEFORE = "1995-01-01"                   # target: games before this day
UPSERT_SOURCE_FROM = "1994-07-01"                     # source: games from this day (overlap = updates)
WEEKEND = (1, 7)                                      # Spark dayofweek: Sunday = 1, Saturday = 7
SATURDAY = 7


def _events(spark, sf):
    return fixtures.read_table(spark, sf, "events")


def _land_events(spark, sf, rows=None):
    root = scratch_path(spark, "landing-events")
    write_landing(rows if rows is not None else _events(spark, sf), root, "ts", mode="dynamic")
    return root


@register("landing_partitions", (
    "SELECT lpad(CAST(year(ts) AS VARCHAR), 4, '0') AS y, lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS m,"
    " lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS d, count(*) AS n FROM events GROUP BY ALL"))
def q_landing_partitions(spark, sf):
    root = _land_events(spark, sf)
    return read_landing(spark, root).groupBy("y", "m", "d").agg(F.count(F.lit(1)).alias("n"))


@register("date_range_scan", (
    "SELECT event_id, ts, value, lpad(CAST(year(ts) AS VARCHAR), 4, '0') AS y,"
    " lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS m, lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS d FROM events"
    f" WHERE CAST(ts AS DATE) BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'"))
def q_date_range_scan(spark, sf):
    root = _land_events(spark, sf)
    return read_landing(spark, root, start=RANGE_START, end=RANGE_END, date_col="ts").select(
        "event_id", "ts", "value", "y", "m", "d")


@register("latest_date", "SELECT max(CAST(ts AS DATE)) AS latest_date FROM events")
def q_latest_date(spark, sf):
    return incremental.latest_date_frame(landed_days(spark, _land_events(spark, sf)), "day")


@register("landed_range", (
    "SELECT min(CAST(ts AS DATE)) AS start_date, max(CAST(ts AS DATE)) AS end_date, count(*) > 0 AS has_new FROM events"))
def q_landed_range(spark, sf):
    return tree_range(spark, _land_events(spark, sf))


@register("missing_days", (
    "SELECT CAST(s.d AS DATE) AS day FROM generate_series("
    "(SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY) s(d)"
    " WHERE CAST(s.d AS DATE) NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE dayofweek(ts) NOT IN (0, 6))"
    " AND CAST(s.d AS DATE) NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE dayofweek(ts) = 6)"))
def q_missing_days(spark, sf):
    """Weekdays landed; Saturdays logged as fetched-but-empty; so Sundays are missing."""
    events = _events(spark, sf)
    rng = incremental.landed_range(events, "ts").first()
    root = _land_events(spark, sf, events.filter(~F.dayofweek("ts").isin(*WEEKEND)))
    log_path = scratch_path(spark, "ingest-log")
    saturdays = events.filter(F.dayofweek("ts") == SATURDAY).select(F.to_date("ts").alias("day")).distinct()
    log_days(spark, log_path, saturdays)
    return incremental.missing_days(landed_days(spark, root), rng["start_date"], rng["end_date"], "day",
                                    log=read_log(spark, log_path))


@register("skip_gate", (
    "SELECT 'landed' AS span, TRUE AS ran, min(CAST(ts AS DATE)) AS start_date, max(CAST(ts AS DATE)) AS end_date FROM events"
    " UNION ALL SELECT 'empty', FALSE, NULL, NULL"))
def q_skip_gate(spark, sf):
    """A step that runs for a range with rows and is skipped for one without."""
    root = _land_events(spark, sf)
    after = incremental.latest_date(landed_days(spark, root), "day") + dt.timedelta(days=1)
    spans = {"landed": tree_range(spark, root), "empty": tree_range(spark, root, after)}
    out = []
    for name, span in spans.items():
        got = incremental.run_if_new(span.first(), lambda lo, hi: (lo, hi))
        out.append((name, got is not None, *(got or (None, None))))
    return spark.createDataFrame(out, "span string, ran boolean, start_date date, end_date date")


@register("local_roundtrip", (
    "SELECT event_id, event_type, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value, n_name AS region_name,"
    " CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(n_nationkey AS DOUBLE) / 4 END AS measure"
    " FROM events JOIN nation ON user_id % 25 = n_nationkey"))
def q_local_roundtrip(spark, sf):
    """Local batches and landed events, both with NaN for missing measures: stored with NULL, all days read back and joined.

    The local table is the fixed one of 25 nations, fetched in batches of ten rows.
    """
    nations = fixtures.read_table(spark, sf, "nation").orderBy("n_nationkey").limit(25).toArrow()
    measure = [float("nan") if k % 4 == 0 else k / 4 for k in nations.column("n_nationkey").to_pylist()]
    fetched = pa.table({"id": nations.column("n_nationkey"), "region_name": nations.column("n_name"), "measure": measure})
    local = from_local_batches(spark, fetched.to_batches(max_chunksize=10), scratch_path(spark, "local"),
                               T.StructType.fromDDL("id long, region_name string, measure double"))
    events = _events(spark, sf)
    with_nan = events.withColumn("value", F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    back = read_landing(spark, _land_events(spark, sf, nan_to_null(with_nan)))
    return (back.join(local, back["user_id"] % 25 == local["id"])
            .select("event_id", "event_type", "value", "region_name", "measure"))


# Until this day events had a narrower user id and no props.
DRIFT_DAY = "2024-01-12"


@register("landing_drift", (
    f"SELECT event_id, ts, user_id, event_type, value, CASE WHEN CAST(ts AS DATE) >= DATE '{DRIFT_DAY}' THEN props END AS props,"
    " lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS d FROM events"))
def q_landing_drift(spark, sf):
    """Days landed before and after the source gained a column and widened a type, read as one table by the recorded schemas."""
    events, root = _events(spark, sf), scratch_path(spark, "landing-drift")
    old = F.to_date("ts") < F.lit(DRIFT_DAY).cast("date")
    write_landing(events.filter(old).drop("props").withColumn("user_id", F.col("user_id").cast("int")), root, "ts")
    write_landing(events.filter(~old), root, "ts")
    return read_landing(spark, root).select("event_id", "ts", "user_id", "event_type", "value", "props", "d")


@register("ingest_days", (
    "SELECT CAST(s.d AS DATE) AS day, (SELECT count(*) FROM events e WHERE CAST(e.ts AS DATE) = CAST(s.d AS DATE)) AS n_landed,"
    f" CASE WHEN CAST(s.d AS DATE) > DATE '{RANGE_START}' THEN (SELECT count(*) FROM events e WHERE CAST(e.ts AS DATE) = CAST(s.d AS DATE))"
    " END AS n_logged FROM generate_series((SELECT min(CAST(ts AS DATE)) FROM events),"
    " (SELECT max(CAST(ts AS DATE)) FROM events) + INTERVAL 2 DAY, INTERVAL 1 DAY) s(d)"))
def q_ingest_days(spark, sf):
    """Days up to RANGE_START are landed; the ingest step fetches, lands and logs all later ones, two of them empty."""
    events = _events(spark, sf)
    rng = incremental.landed_range(events, "ts").first()
    root = _land_events(spark, sf, events.filter(F.to_date("ts") <= F.lit(RANGE_START).cast("date")))
    log_path = scratch_path(spark, "ingest-log")
    end = rng["end_date"] + dt.timedelta(days=2)

    def fetch(days):
        return events.join(days, F.to_date("ts") == F.col("day"), "left_semi")

    runner.ingest(spark, root, log_path, fetch, end, "ts")
    runner.ingest(spark, root, log_path, fetch, end, "ts")  # nothing is left to ask for
    spine = spark.range(1).select(F.explode(F.sequence(F.lit(rng["start_date"]), F.lit(end))).alias("day"))
    landed = read_landing(spark, root).groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_landed"))
    logged = read_log(spark, log_path).groupBy("day").agg(F.sum("n_rows").alias("n_logged"))
    return (spine.join(landed, "day", "left").join(logged, "day", "left")
            .select("day", F.coalesce("n_landed", F.lit(0).cast("long")).alias("n_landed"), "n_logged"))


@register("upsert_three_keys", with_ctes(
    f"SELECT t.* FROM pitches t WHERE game_date < DATE '{UPSERT_TARGET_BEFORE}'"
    f" AND NOT EXISTS (SELECT 1 FROM pitches s WHERE s.game_date >= DATE '{UPSERT_SOURCE_FROM}' AND s.game_pk = t.game_pk"
    " AND s.at_bat_number = t.at_bat_number AND s.pitch_number = t.pitch_number)"
    " UNION ALL SELECT * REPLACE (home_score + 1 AS home_score) FROM pitches"
    f" WHERE game_date >= DATE '{UPSERT_SOURCE_FROM}'", "pitches"))
def q_upsert_three_keys(spark, sf):
    """Three-key upsert, all columns compared."""
    p = fixtures.pitches(spark, sf)
    target = p.filter(F.col("game_date") < F.lit(UPSERT_TARGET_BEFORE).cast("date"))
    source = (p.filter(F.col("game_date") >= F.lit(UPSERT_SOURCE_FROM).cast("date"))
              .withColumn("home_score", F.col("home_score") + 1))
    return merge_rows(target, source, PITCH_KEYS)


# A partitioned upsert: by month, with rows that have none, and keys whose month moves.
_MONTH = "CASE WHEN game_pk % 97 = 0 THEN NULL ELSE CAST(date_trunc('month', game_date) AS DATE) END"
_NEXT_MONTH = ("CASE WHEN game_pk % 97 = 0 THEN NULL WHEN game_pk % 5 = 0 THEN"
               " CAST(date_trunc('month', game_date) + INTERVAL 1 MONTH AS DATE) ELSE CAST(date_trunc('month', game_date) AS DATE) END")


@register("upsert_partitioned", with_ctes(
    f"SELECT t.*, {_MONTH} AS month FROM pitches t WHERE game_date < DATE '{UPSERT_TARGET_BEFORE}'"
    f" AND NOT EXISTS (SELECT 1 FROM pitches s WHERE s.game_date >= DATE '{UPSERT_SOURCE_FROM}' AND s.game_pk = t.game_pk"
    " AND s.at_bat_number = t.at_bat_number AND s.pitch_number = t.pitch_number)"
    f" UNION ALL SELECT * REPLACE (home_score + 1 AS home_score), {_NEXT_MONTH} AS month FROM pitches"
    f" WHERE game_date >= DATE '{UPSERT_SOURCE_FROM}'", "pitches"))
def q_upsert_partitioned(spark, sf):
    """Three-key upsert into a stored table partitioned by month; only touched months are rewritten; all columns compared."""
    layout = Layout(spark, scratch_path(spark, "layout-pitches"))
    p = fixtures.pitches(spark, sf)
    month = F.trunc("game_date", "month")
    none = F.col("game_pk") % 97 == 0
    target = p.filter(F.col("game_date") < F.lit(UPSERT_TARGET_BEFORE).cast("date")).withColumn("month", F.when(~none, month))
    source = (p.filter(F.col("game_date") >= F.lit(UPSERT_SOURCE_FROM).cast("date")).withColumn("home_score", F.col("home_score") + 1)
              .withColumn("month", F.when(~none, F.when(F.col("game_pk") % 5 == 0, F.add_months(month, 1)).otherwise(month))))
    layout.upsert("pitches", target, PITCH_KEYS, partition_by="month")
    return layout.upsert("pitches", source, PITCH_KEYS, partition_by="month")


_SUMMARY_COLS = ["game_pk", "date", "home_team", "home_score", "away_score", "winner", "home_pitch_count"]


@register("upsert_one_key", with_ctes(
    f"SELECT {', '.join(_SUMMARY_COLS)} FROM summary t WHERE date < DATE '{UPSERT_TARGET_BEFORE}'"
    f" AND NOT EXISTS (SELECT 1 FROM summary s WHERE s.date >= DATE '{UPSERT_SOURCE_FROM}' AND s.game_pk = t.game_pk)"
    " UNION ALL SELECT game_pk, date, home_team, home_score + 1 AS home_score, away_score, winner, home_pitch_count"
    f" FROM summary WHERE date >= DATE '{UPSERT_SOURCE_FROM}'", "summary"))
def q_upsert_one_key(spark, sf):
    """Create-or-merge on a stored table keyed by game: the first upsert creates it, the second merges."""
    layout = Layout(spark, scratch_path(spark, "layout-gold"))
    summary = catalog._summary(spark, sf).select(*_SUMMARY_COLS)
    target = summary.filter(F.col("date") < F.lit(UPSERT_TARGET_BEFORE).cast("date"))
    source = (summary.filter(F.col("date") >= F.lit(UPSERT_SOURCE_FROM).cast("date"))
              .withColumn("home_score", F.col("home_score") + 1))
    layout.upsert("game_summary", target, ["game_pk"])
    return layout.upsert("game_summary", source, ["game_pk"])


@register("csv_lookup_roundtrip", with_ctes(
    "SELECT key_mlbam, name_first, name_last, TRUE AS from_csv, TRUE AS stamped FROM lookup", "lookup"))
def q_csv_lookup_roundtrip(spark, sf):
    path = scratch_path(spark, "lookup-csv")
    write_lookup_csv(fixtures.lookup(spark, sf), path)
    rows = with_source_file(incremental.with_audit(read_lookup_csv(spark, f"{path}/part-*.csv"), "ingestion_timestamp"))
    return rows.select("key_mlbam", "name_first", "name_last",
                       F.col("source_file").endswith(".csv").alias("from_csv"),
                       F.col("ingestion_timestamp").isNotNull().alias("stamped"))


@register("partitioned_table_roundtrip", with_ctes(
    "SELECT date, count(*) AS n, CAST(sum(home_score + CASE WHEN date = (SELECT max(date) FROM silver) THEN 1 ELSE 0 END)"
    " AS BIGINT) AS sum_home_score FROM silver GROUP BY date", "silver"))
def q_partitioned_table_roundtrip(spark, sf):
    """Silver written partitioned by date, then its latest day replaced (dynamic overwrite)."""
    layout = Layout(spark, scratch_path(spark, "layout-silver"))
    layout.write("silver", catalog._silver(spark, sf), partition_by="date")
    stored = layout.read("silver")
    last = incremental.latest_date(stored, "date")
    changed = stored.filter(F.col("date") == F.lit(last)).withColumn("home_score", F.col("home_score") + 1)
    layout.write("silver", changed.select(*stored.columns), partition_by="date", mode="dynamic")
    return (layout.read("silver").groupBy(F.col("date").cast("date").alias("date"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("home_score").cast("long").alias("sum_home_score")))


@register("stream_bronze", (
    "SELECT event_id, ts, user_id, event_type, value + CASE WHEN CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"
    " THEN 1 ELSE 0 END AS value, props, CAST(ts AS DATE) AS day FROM events"))
def q_stream_bronze(spark, sf):
    """Land all days, stream them into bronze, re-land the latest day corrected, stream again."""
    events = _events(spark, sf)
    root = _land_events(spark, sf, events)
    layout = Layout(spark, scratch_path(spark, "layout-stream"))
    ckpt = scratch_path(spark, "stream-ckpt")
    schema = events.schema
    stream_bronze(spark, root, schema, layout, "bronze_events", ["event_id"], ckpt, partition_by="day", day_of="ts")
    last = incremental.latest_date(events, "ts")
    corrected = events.filter(F.to_date("ts") == F.lit(last)).withColumn("value", F.col("value") + 1)
    write_landing(corrected, root, "ts", mode="dynamic")
    stream_bronze(spark, root, schema, layout, "bronze_events", ["event_id"], ckpt, partition_by="day", day_of="ts")
    return layout.read("bronze_events").select(*schema.names, "day")


# The daily pipeline.  All games of a month are landed on its first day (84 days instead of 2,400 keep
# the number of folders small).  Those from RELANDED_FROM on are landed again, some as exhibition games,
# some in another season.
RELANDED_FROM = "1998-05-01"
_DAY = "CAST(date_trunc('month', game_date) AS DATE)"
_LANDED = f"{_DAY} AS game_date"
_RELANDED = (
    f"CASE WHEN game_date >= DATE '{RELANDED_FROM}' AND game_pk % 11 = 0 THEN 'S' ELSE game_type END AS game_type,"
    f" CASE WHEN game_date >= DATE '{RELANDED_FROM}' AND game_pk % 7 = 0 THEN CAST({_DAY} + INTERVAL 400 DAY AS DATE)"
    f" ELSE {_DAY} END AS game_date")


def _over_landed(changes: str, body: str, *needs: str) -> str:
    """``body`` over the pitches with ``changes`` to their columns."""
    rest = with_ctes(body, *needs)[len("WITH " + catalog.CTE_PITCHES):]
    landed = catalog.CTE_PITCHES.replace("pitches AS (", "landed AS (", 1)
    return f"WITH {landed},\npitches AS (SELECT * REPLACE ({changes}) FROM landed){rest}"


def _by_month(spark, sf):
    return fixtures.pitches(spark, sf).withColumn("game_date", F.trunc("game_date", "month"))


def _land_pitches(spark, rows, name):
    root = scratch_path(spark, name)
    write_landing(rows, root, "game_date")
    return root


def _load(spark, sf):
    """All pitches landed by day and loaded into every layer."""
    layout = Layout(spark, scratch_path(spark, "layout-pipeline"))
    register_csv = scratch_path(spark, "register-csv")
    write_lookup_csv(fixtures.lookup(spark, sf).repartition("key_mlbam"), register_csv)  # all rows of an id in one file
    runner.load_players(spark, layout, f"{register_csv}/part-*.csv")
    root = _land_pitches(spark, _by_month(spark, sf), "landing-pitches")
    runner.full_load(spark, layout, read_bronze_source(spark, root))
    return layout


@register("pipeline_full", _over_landed(_LANDED, "SELECT * FROM summary", "summary"))
def q_pipeline_full(spark, sf):
    """Landing, bronze, silver, enriched and gold tables, written and read back."""
    return _load(spark, sf).read(runner.GAMES).drop("season")


def _increment(spark, sf):
    """A full load, then one increment of days landed again."""
    layout = _load(spark, sf)
    late = F.col("game_date") >= F.lit(RELANDED_FROM).cast("date")
    rows = (_by_month(spark, sf).filter(late)
            .withColumn("game_type", F.when(F.col("game_pk") % 11 == 0, "S").otherwise(F.col("game_type")))
            .withColumn("game_date", F.when(F.col("game_pk") % 7 == 0, F.date_add("game_date", 400)).otherwise(F.col("game_date"))))
    root = _land_pitches(spark, rows, "landing-again")
    last = incremental.latest_date(landed_days(spark, root), "day")
    landed = read_bronze_source(spark, root, RELANDED_FROM, last)
    runner.incremental_run(spark, layout, landed, RELANDED_FROM, last)
    return layout


@register("pipeline_incremental", _over_landed(_RELANDED, "SELECT * FROM yearly", "yearly"))
def q_pipeline_incremental(spark, sf):
    """The seasons after an increment equal a full load of the final rows."""
    return _increment(spark, sf).read(runner.PITCHERS)


@register("pipeline_incremental_games", _over_landed(_RELANDED, "SELECT * FROM summary", "summary"))
def q_pipeline_incremental_games(spark, sf):
    """The game summaries after an increment equal a full load of the final rows."""
    return _increment(spark, sf).read(runner.GAMES).drop("season")


# The register of a later load: some people are renamed, some ids are given a second row.
_LATER_REGISTER = (
    catalog.CTE_LOOKUP.replace("lookup AS (", "lookup0 AS (", 1) + ",\nlookup AS (SELECT key_mlbam,"
    " CASE WHEN TRY_CAST(key_mlbam AS BIGINT) % 30 = 1 THEN 'Renamed' ELSE name_first END AS name_first, name_last FROM lookup0"
    " UNION ALL SELECT key_mlbam, 'zz', 'Twin' FROM lookup0 WHERE TRY_CAST(key_mlbam AS BIGINT) % 70 = 7)")


def _register_change(spark, sf):
    """A full load, then the register again with changes; the games of changed people get their new names."""
    layout = _load(spark, sf)
    people, key = fixtures.lookup(spark, sf), F.col("key_mlbam").try_cast("long")
    later = people.withColumn("name_first", F.when(key % 30 == 1, "Renamed").otherwise(F.col("name_first"))).unionByName(
        people.filter(key % 70 == 7).select("key_mlbam", F.lit("zz").alias("name_first"), F.lit("Twin").alias("name_last")))
    path = scratch_path(spark, "register-csv")
    write_lookup_csv(later.repartition("key_mlbam"), path)
    runner.refresh_players(spark, layout, f"{path}/part-*.csv")
    runner.reenrich(spark, layout)
    return layout


@register("register_change", _over_landed(_LANDED, "SELECT game_pk, at_bat_number, pitch_number, date, batter, pitcher FROM enriched", "enriched")
          .replace(catalog.CTE_LOOKUP, _LATER_REGISTER))
def q_register_change(spark, sf):
    """The names of all pitches after the register changed equal a full load with the later register."""
    return _register_change(spark, sf).read(runner.ENRICHED).select("game_pk", "at_bat_number", "pitch_number", "date", "batter", "pitcher")


@register("register_change_yearly", _over_landed(_LANDED, "SELECT * FROM yearly", "yearly").replace(catalog.CTE_LOOKUP, _LATER_REGISTER))
def q_register_change_yearly(spark, sf):
    """The seasons after the register changed equal a full load with the later register."""
    return _register_change(spark, sf).read(runner.PITCHERS)
