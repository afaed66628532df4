import math

from pyspark.sql import functions as F

from conftest import SF0001, rows
from pitchlake.plans import silver
from pitchlake.sources import fixtures
from pitchlake.sources.local import from_local, nan_to_null


def test_competitive_only_drops_s_e_and_null(spark):
    df = spark.createDataFrame([("R",), ("S",), ("E",), (None,), ("F",)], "game_type string")
    assert rows(silver.competitive_only(df)) == [("F",), ("R",)]


def test_silver_players_names_ids_and_duplicates(spark):
    df = spark.createDataFrame([
        ("12.0", " Ann ", "Lee "),   # fractional id text is cut
        ("7", None, "Solo"),        # NULL first name skipped
        ("8", None, None),          # both NULL -> ''
        (None, "No", "Id"),         # dropped
        ("x1", "Bad", "Id"),        # not a number -> NULL id
        ("9", "B", "Two"),          # duplicate id: one row survives
        ("9", "A", "One"),
    ], "key_mlbam string, name_first string, name_last string")
    got = rows(silver.silver_players(df), "player_id", "player_name")
    assert got == [(7, "Solo"), (8, ""), (9, "B Two"), (12, "Ann Lee"), (None, "Bad Id")]
    scd = silver.silver_players(df).select("end_date", "is_current").distinct().collect()
    assert [tuple(r) for r in scd] == [(None, True)]


def test_nan_becomes_null(spark):
    import pandas as pd

    pdf = pd.DataFrame({"spin_axis": [1.5, float("nan")], "zone": [1, 2]})
    df = from_local(spark, pdf)
    got = rows(df, "spin_axis")
    assert got == [(1.5,), (None,)]
    assert nan_to_null(spark.createDataFrame([(math.nan,)], "x double")).first()[0] is None


def test_silver_projection_columns(spark):
    p = fixtures.pitches(spark, SF0001)
    s = silver.silver_base(p)
    assert len(s.columns) == 72  # 73 minus processed_timestamp (not stamped here)
    assert "idx_game_pitch" in s.columns and "pitch_zone_catcher_view" in s.columns
    assert dict(s.dtypes)["spin_axis_degree"] == "int"
    assert s.filter(F.col("game_type").isNull()).count() == 0


def test_enrich_replaces_ids_with_names(spark):
    p = fixtures.pitches(spark, SF0001)
    e = silver.enrich(silver.silver_base(p, index=False), silver.silver_players(fixtures.lookup(spark, SF0001)))
    assert dict(e.dtypes)["batter"] == "string" and dict(e.dtypes)["pitcher"] == "string"
    assert dict(e.dtypes)["fielder_2"] == "bigint"
    # rows are not multiplied by the lookup
    assert e.count() == silver.silver_base(p, index=False).count()
