import datetime as dt

from pyspark.sql import functions as F

from conftest import SF0001
from pitchlake.plans import runner
from pitchlake.sinks.landing import write_landing
from pitchlake.sinks.layout import Layout
from pitchlake.sinks.upsert import merge_rows
from pitchlake.sources import fixtures
from pitchlake.sources.lookup import write_lookup_csv

SPLIT = dt.date(1995, 6, 17)
KEYS = ["game_pk", "at_bat_number", "pitch_number"]


def _inputs(spark, root):
    # sf0.001 holds one duplicated pitch key; keep one row of it (upserts reject duplicates)
    # three months around the split keep the number of day partitions small
    p = fixtures.pitches(spark, SF0001).filter(F.col("game_date").between("1995-05-01", "1995-07-31"))
    dup = p.groupBy(*KEYS).count().filter("count > 1").select(*KEYS)
    p = merge_rows(p.join(dup, KEYS, "left_anti"), p.join(dup, KEYS, "left_semi").dropDuplicates(KEYS), KEYS)
    landing = f"{root}/landing"
    write_landing(p, landing, "game_date")
    write_lookup_csv(fixtures.lookup(spark, SF0001), f"{root}/people")
    return landing


def _table(layout, name, drop=()):
    df = layout.read(name).drop("processed_timestamp", "ingestion_timestamp", *drop)
    key = lambda t: tuple((True, "") if x is None else (False, str(x)) for x in t)
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=key)


def test_incremental_equals_full_load(spark, tmp_root):
    from pitchlake.plans.bronze import read_bronze_source

    landing = _inputs(spark, tmp_root)
    landed = read_bronze_source(spark, landing)
    full, inc = Layout(spark, f"{tmp_root}/full"), Layout(spark, f"{tmp_root}/inc")
    for lay in (full, inc):
        runner.load_players(spark, lay, f"{tmp_root}/people/part-*.csv")
    runner.full_load(spark, full, landed)

    assert set(landed.columns) <= set(full.read(runner.BRONZE).columns) | {"y", "m", "d"}
    first = landed.filter(F.col("game_date") < F.lit(SPLIT))
    runner.full_load(spark, inc, first)
    from pitchlake.operators.incremental import latest_date
    last = latest_date(landed, "game_date")
    assert runner.incremental_run(spark, inc, landed, SPLIT, last) is True
    assert runner.incremental_run(spark, inc, landed, "2030-01-01", "2030-01-02") is False

    for name in (runner.SILVER, runner.ENRICHED, runner.GAMES):
        assert _table(full, name) == _table(inc, name), name
    assert _table(full, runner.PITCHERS) == _table(inc, runner.PITCHERS)
    silver = full.read(runner.SILVER)
    per_game = silver.groupBy("game_pk").agg(F.count(F.lit(1)).alias("n"), F.max("idx_game_pitch").alias("m"),
                                             F.countDistinct("idx_game_pitch").alias("d"))
    assert per_game.filter("n != m OR n != d").count() == 0


def test_games_that_change_type_or_season(spark, tmp_root):
    from pitchlake.plans.bronze import read_bronze_source

    landing = _inputs(spark, tmp_root)
    landed = read_bronze_source(spark, landing)
    late = F.col("game_date") >= F.lit(SPLIT)
    changed = landed.withColumn("game_type", F.when(late & (F.col("game_pk") % 3 == 0), "S").otherwise(F.col("game_type"))).withColumn(
        "game_date", F.when(late & (F.col("game_pk") % 5 == 0), F.date_add("game_date", 400)).otherwise(F.col("game_date")))
    full, inc = Layout(spark, f"{tmp_root}/full"), Layout(spark, f"{tmp_root}/inc")
    for lay in (full, inc):
        runner.load_players(spark, lay, f"{tmp_root}/people/part-*.csv")
    runner.full_load(spark, full, changed)
    runner.full_load(spark, inc, landed)
    assert runner.incremental_run(spark, inc, changed.filter(F.col("game_date") >= F.lit(SPLIT)).drop("y", "m", "d"), SPLIT, "2030-01-01")
    for name in (runner.SILVER, runner.ENRICHED, runner.GAMES, runner.PITCHERS):
        assert _table(full, name) == _table(inc, name), name


def test_register_changes_reach_the_names_of_old_games(spark, tmp_root):
    from pitchlake.plans.bronze import read_bronze_source

    landed = read_bronze_source(spark, _inputs(spark, tmp_root))
    people = fixtures.lookup(spark, SF0001).repartition(1)
    key = F.col("key_mlbam").try_cast("long")
    later = (people.filter(key.isNull() | (key % 9 != 0)).withColumn("name_first", F.when(key % 30 == 1, "Renamed").otherwise(F.col("name_first")))
             .unionByName(people.filter(key % 70 == 7).select("key_mlbam", F.lit("zz").alias("name_first"), F.lit("Twin").alias("name_last"))).repartition(1))
    write_lookup_csv(later, f"{tmp_root}/later")
    full, inc = Layout(spark, f"{tmp_root}/full"), Layout(spark, f"{tmp_root}/inc")
    runner.load_players(spark, full, f"{tmp_root}/later/part-*.csv")
    runner.full_load(spark, full, landed)
    runner.load_players(spark, inc, f"{tmp_root}/people/part-*.csv")
    runner.full_load(spark, inc, landed)
    assert runner.refresh_players(spark, inc, f"{tmp_root}/people/part-*.csv").count() == 0  # the same register: nobody changed
    assert runner.reenrich(spark, inc) is False
    changed = {r[0] for r in runner.refresh_players(spark, inc, f"{tmp_root}/later/part-*.csv").collect()}
    # Of an id with several rows the file decides too (k % 20 == 1).
    assert {k % 30 == 1 or k % 9 == 0 or k % 70 == 7 or k % 20 == 1 for k in changed} == {True} and any(k % 9 == 0 for k in changed)
    assert runner.reenrich(spark, inc) is True
    for name in (runner.ENRICHED, runner.GAMES, runner.PITCHERS, runner.PITCHER_DAYS):
        assert _table(full, name) == _table(inc, name), name


def test_a_stored_register_meets_the_days_without_a_shuffle(spark, tmp_root, monkeypatch):
    from pitchlake.plans import silver
    from pitchlake.plans.bronze import read_bronze_source

    layout = Layout(spark, f"{tmp_root}/t")
    rows = read_bronze_source(spark, _inputs(spark, tmp_root)).withColumn(
        "batter", F.when(F.col("pitch_number") != 3, F.col("batter")))
    runner.load_players(spark, layout, f"{tmp_root}/people/part-*.csv")
    layout.write(runner.SILVER, silver.silver_base(rows), partition_by="date")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = silver.enrich_by_day(layout.read(runner.SILVER), layout.read(runner.PLAYERS))
        assert "Exchange hashpartitioning" not in named._jdf.queryExecution().executedPlan().toString()
        layout.write("small", named, partition_by="date", gathered=True)
        monkeypatch.setattr(silver, "fits_in_memory", lambda players: False)
        layout.write("large", silver.enrich_by_day(layout.read(runner.SILVER), layout.read(runner.PLAYERS)), partition_by="date", gathered=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert _table(layout, "small") == _table(layout, "large")


def test_games_over_two_days_beside_an_increment(spark, tmp_root):
    from pitchlake.plans.bronze import read_bronze_source

    landed, odd = read_bronze_source(spark, _inputs(spark, tmp_root)), F.col("pitch_number") % 2 == 1
    before, day = F.lit(SPLIT - dt.timedelta(days=2)), F.col("game_date")
    # Odd pitches of some games of either side lie two days before the split: of changed games, and of games that nobody changes.
    moved = (F.col("game_pk") % 3 == 0) & day.between(F.lit(SPLIT), F.lit(SPLIT + dt.timedelta(days=10)))
    still = (F.col("game_pk") % 3 == 1) & day.between(F.lit(SPLIT - dt.timedelta(days=20)), F.lit(SPLIT - dt.timedelta(days=3)))
    rows = landed.withColumn("game_date", F.when(odd & (moved | still), before).otherwise(day)).drop("y", "m", "d")
    full, inc = Layout(spark, f"{tmp_root}/full"), Layout(spark, f"{tmp_root}/inc")
    for lay in (full, inc):
        runner.load_players(spark, lay, f"{tmp_root}/people/part-*.csv")
    runner.full_load(spark, full, rows)
    runner.full_load(spark, inc, rows.filter(F.col("game_date") < F.lit(SPLIT)))
    assert runner.incremental_run(spark, inc, rows, SPLIT, "2030-01-01") is True
    assert inc.read(runner.OPEN_GAMES).count() > 0
    for name in (runner.GAME_DAYS, runner.SILVER, runner.ENRICHED, runner.GAMES, runner.PITCHER_DAYS, runner.PITCHERS):
        assert _table(full, name) == _table(inc, name), name


def test_parts_by_day_add_up(spark):
    from pitchlake import catalog
    from pitchlake.plans import gold

    enriched = catalog._enriched(spark, SF0001)
    by_day = gold.pitcher_parts(enriched, ("date", *gold.PITCHER_KEYS))
    from conftest import rows
    assert rows(gold.with_rates(gold.merged_parts(by_day))) == rows(gold.pitcher_yearly(enriched))
