from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pitchlake.functions.exact import avg_from_parts, avg_parts
from pitchlake.functions.labels import label, resolve_sides
from pitchlake.functions.rates import percent, safe_rate
from pitchlake.functions.units import convert_units
from pitchlake.plans.silver import code_labels
from pitchlake.schemas import GAME_TYPE_LABELS, ZONE_LABELS, UnitSpec


def test_label_unknown_code_is_null(spark):
    df = spark.createDataFrame([(1,), (10,), (None,), (14,)], "zone int")
    got = rows(df.select("zone", label("zone", ZONE_LABELS).alias("z")))
    assert got == [(1, "high-left"), (10, None), (14, "waste-low-right"), (None, None)]


def test_game_type_labels_documented_map(spark):
    df = spark.createDataFrame([("R",), ("W",), ("F",), ("D",), ("L",), ("X",)], "game_type string")
    got = dict(rows(df.select("game_type", label("game_type", GAME_TYPE_LABELS).alias("l"))))
    assert got == {"R": "Regular Season", "W": "World Series", "F": "Wild Card", "D": "Divisional Series",
                   "L": "League Championship Series", "X": None}


def test_code_labels_contact_and_zone(spark):
    df = spark.createDataFrame([("R", 6, 5), ("R", 7, None)], "game_type string, launch_speed_angle int, zone int")
    got = rows(df.select(*code_labels()))
    assert got == [("Regular Season", "Barrel", "middle-center"), ("Regular Season", None, None)]


def test_resolve_sides(spark):
    df = spark.createDataFrame([("Top", "H", "A"), ("Bot", "H", "A"), ("Mid", "H", "A"), (None, "H", "A")],
                               "inning_topbot string, home_team string, away_team string")
    got = rows(df.select("inning_topbot", *resolve_sides()))
    assert got == [("Bot", "H", "A"), ("Mid", None, None), ("Top", "A", "H"), (None, None, None)]


def test_unit_conversion_rounds_to_two_places(spark):
    df = spark.createDataFrame([(100.0,), (None,), (0.1,)], "release_speed double")
    got = rows(df.select(*convert_units([UnitSpec("release_speed", 1.60934, "kmh")])))
    assert got == [(0.16,), (160.93,), (None,)]


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 2.01],            # 1.67 exactly .00333
    [0.01, 0.02],                # .015 -> .02 (half away from zero)
    [-0.01, -0.02],              # -.015 -> -.02
    [10.05, 10.06, 10.07, 10.08],
    [None, 3.33],
])
def test_exact_average_half_away_from_zero(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(*avg_parts("x", "a")).select(avg_from_parts("a")).first()[0]
    present = [Decimal(str(v)) for v in values if v is not None]
    exact = sum(present) / len(present)
    mag = abs(exact).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    want = float(mag if exact >= 0 else -mag)
    assert got == want


def test_exact_average_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(*avg_parts("x", "a")).select(avg_from_parts("a")).first()[0] is None


def test_safe_rate_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 3), (0, 0)], "n long, d long")
    got = rows(df.select(safe_rate("n", "d").alias("r")))
    assert got == [(0.0,), (0.0,), (0.33333,)]


def test_percent_zero_total_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 8)], "n long, d long")
    assert rows(df.select(percent("n", "d").alias("p"))) == [(12.5,), (None,)]
