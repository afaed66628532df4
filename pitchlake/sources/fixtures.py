"""Pitch-shaped inputs derived from the driver's TPC-H-style tables.

The driver tables are not pitch-shaped, so one deterministic projection of
``lineitem ⋈ orders ⋈ customer ⋈ nation×2 ⋈ part`` gives them the 69 raw
columns silver reads (``pitches``) and a person register (``lookup``).  The
column expressions are SQL text used twice: by Spark through ``selectExpr``
on a DataFrame join, and by the DuckDB oracle as a CTE, so both sides see
the very same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The projection that shapes the driver tables like raw pitches.
PITCH_VIEW_COLUMNS: tuple[str, ...] = (
    "o.o_orderkey AS game_pk",
    "CAST(o.o_orderdate AS DATE) AS game_date",
    "CASE WHEN o.o_orderkey % 41 = 0 THEN 'F' WHEN o.o_orderkey % 43 = 0 THEN 'E' WHEN o.o_orderkey % 47 = 0 THEN NULL ELSE"
    " CASE substr(o.o_orderpriority,1,1) WHEN '1' THEN 'R' WHEN '2' THEN 'W' WHEN '3' THEN 'D' WHEN '4' THEN 'L' ELSE 'S' END END AS game_type",
    "h.n_name AS home_team",
    "a.n_name AS away_team",
    "CASE WHEN l.l_partkey % 53 = 0 THEN 'Mid' WHEN l.l_linenumber % 2 = 1 THEN 'Top' ELSE 'Bot' END AS inning_topbot",
    "l.l_partkey*10000 + l.l_suppkey AS at_bat_number",
    "l.l_linenumber AS pitch_number",
    "l.l_partkey AS batter",
    "10000000 + l.l_suppkey AS pitcher",
    "CAST(l.l_suppkey % 10 AS INT) AS home_score",
    "CAST(l.l_partkey % 10 AS INT) AS away_score",
    "CASE WHEN l.l_quantity <= 5 THEN 'single' WHEN l.l_quantity <= 8 THEN 'double' WHEN l.l_quantity <= 9 THEN 'triple' WHEN l.l_quantity <= 11 THEN 'home_run'"
    " WHEN l.l_quantity <= 18 THEN 'strikeout' WHEN l.l_quantity <= 19 THEN 'strikeout_double_play' WHEN l.l_quantity <= 22 THEN 'walk' WHEN l.l_quantity <= 23 THEN 'intent_walk'"
    " WHEN l.l_quantity <= 24 THEN 'hit_by_pitch' WHEN l.l_quantity <= 25 THEN 'fielders_choice' WHEN l.l_quantity <= 26 THEN 'fielders_choice_out' END AS events",
    "CASE CAST(round(l.l_tax*100,0) AS INT) WHEN 0 THEN 'ball' WHEN 1 THEN 'called_strike' WHEN 2 THEN 'swinging_strike' WHEN 3 THEN 'swinging_strike_blocked' WHEN 4 THEN 'foul'"
    " WHEN 5 THEN 'foul_tip' WHEN 6 THEN 'hit_into_play' WHEN 7 THEN 'missed_bunt' ELSE 'swinging_pitchout' END AS description",
    "CASE p.p_size % 16 WHEN 0 THEN '4-Seam Fastball' WHEN 1 THEN 'Sinker' WHEN 2 THEN 'Cutter' WHEN 3 THEN 'Slider' WHEN 4 THEN 'Sweeper' WHEN 5 THEN 'Curveball'"
    " WHEN 6 THEN 'Knuckle Curve' WHEN 7 THEN 'Slurve' WHEN 8 THEN 'Slow Curve' WHEN 9 THEN 'Knuckleball' WHEN 10 THEN 'Changeup' WHEN 11 THEN 'Split-Finger'"
    " WHEN 12 THEN 'Forkball' WHEN 13 THEN 'Screwball' WHEN 14 THEN 'Pitch Out' END AS pitch_name",
    "CASE WHEN l.l_suppkey % 17 <> 0 THEN CAST(70 AS DOUBLE) + l.l_quantity*CAST(0.5 AS DOUBLE) END AS release_speed",
    "CASE WHEN l.l_quantity <= 11 THEN CAST(50 + l.l_partkey % 70 AS DOUBLE) END AS launch_speed",
    "CASE WHEN l.l_tax >= 0.02 THEN CAST(55 + l.l_suppkey % 30 AS DOUBLE) END AS bat_speed",
    "CASE WHEN l.l_quantity <= 11 THEN CAST(1 + l.l_partkey % 6 AS INT) END AS launch_speed_angle",
    "CAST(1 + l.l_suppkey % 14 AS INT) AS zone",
    "CAST(l.l_partkey % 41 - 20 AS DOUBLE)*CAST(0.0625 AS DOUBLE) AS pfx_x",
    "CAST(l.l_suppkey % 33 - 16 AS DOUBLE)*CAST(0.0625 AS DOUBLE) AS pfx_z",
    "CAST(l.l_partkey % 360 AS DOUBLE) AS spin_axis",
    "p.p_brand AS pitch_type",
    "CAST(l.l_partkey % 21 - 10 AS DOUBLE)*CAST(0.015625 AS DOUBLE) AS delta_home_win_exp",
    "CAST(l.l_suppkey % 21 - 10 AS DOUBLE)*CAST(0.03125 AS DOUBLE) AS delta_run_exp",
    "CASE l.l_returnflag WHEN 'A' THEN 'Standard' WHEN 'N' THEN 'Strategic' ELSE 'Infield shade' END AS if_fielding_alignment",
    "CASE l.l_linestatus WHEN 'F' THEN 'Standard' ELSE 'Strategic' END AS of_fielding_alignment",
    "CAST(l.l_partkey % 61 AS DOUBLE)*CAST(0.5 AS DOUBLE) AS intercept_ball_minus_batter_pos_x_inches",
    "CAST(l.l_suppkey % 61 AS DOUBLE)*CAST(0.5 AS DOUBLE) AS intercept_ball_minus_batter_pos_y_inches",
    "CAST(1 + l.l_partkey % 9 AS INT) AS inning",
    "CAST(l.l_partkey % 4 AS INT) AS balls",
    "CAST(l.l_suppkey % 3 AS INT) AS strikes",
    "CASE WHEN l.l_quantity <= 11 THEN CAST(1 + l.l_suppkey % 9 AS INT) END AS hit_location",
    "CAST(l.l_partkey % 3 AS INT) AS outs_when_up",
    "CASE WHEN l.l_partkey % 3 = 0 THEN l.l_partkey END AS on_1b",
    "CASE WHEN l.l_partkey % 5 = 0 THEN l.l_partkey END AS on_2b",
    "CASE WHEN l.l_partkey % 7 = 0 THEN l.l_partkey END AS on_3b",
    "10000000 + (l.l_suppkey + 2) % 10 AS fielder_2",
    "10000000 + (l.l_suppkey + 3) % 10 AS fielder_3",
    "10000000 + (l.l_suppkey + 4) % 10 AS fielder_4",
    "10000000 + (l.l_suppkey + 5) % 10 AS fielder_5",
    "10000000 + (l.l_suppkey + 6) % 10 AS fielder_6",
    "10000000 + (l.l_suppkey + 7) % 10 AS fielder_7",
    "10000000 + (l.l_suppkey + 8) % 10 AS fielder_8",
    "10000000 + (l.l_suppkey + 9) % 10 AS fielder_9",
    "CAST(l.l_partkey % 23 - 7 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS release_pos_x",
    "CAST(l.l_suppkey % 29 - 9 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS release_pos_y",
    "CAST(l.l_partkey % 31 - 10 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS release_pos_z",
    "CAST(l.l_suppkey % 37 - 12 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS plate_x",
    "CAST(l.l_partkey % 43 - 14 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS plate_z",
    "CAST(l.l_suppkey % 47 - 15 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS sz_top",
    "CAST(l.l_partkey % 53 - 17 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS sz_bot",
    "CAST(l.l_suppkey % 59 - 19 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS swing_length",
    "CAST(l.l_partkey % 61 - 20 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS hc_x",
    "CAST(l.l_suppkey % 67 - 22 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS hc_y",
    "CAST(l.l_partkey % 71 - 23 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS vx0",
    "CAST(l.l_suppkey % 73 - 24 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS vy0",
    "CAST(l.l_partkey % 79 - 26 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS vz0",
    "CAST(l.l_suppkey % 83 - 27 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS ax",
    "CAST(l.l_partkey % 89 - 29 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS ay",
    "CAST(l.l_suppkey % 97 - 32 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS az",
    "CAST(l.l_partkey % 101 - 33 AS DOUBLE)*CAST(0.125 AS DOUBLE) AS hit_distance_sc",
    "CASE WHEN l.l_suppkey % 3 = 0 THEN 'L' ELSE 'R' END AS p_throws",
    "CASE WHEN l.l_partkey % 2 = 0 THEN 'L' ELSE 'R' END AS stand",
    "p.p_name AS des",
    "CASE WHEN l.l_tax < 0.005 THEN 'B' WHEN l.l_tax < 0.055 THEN 'S' ELSE 'X' END AS type",
    "CASE WHEN l.l_quantity <= 11 THEN CASE l.l_partkey % 4 WHEN 0 THEN 'ground_ball' WHEN 1 THEN 'fly_ball' WHEN 2 THEN 'line_drive' ELSE 'popup' END END AS bb_type",
    "CAST(l.l_suppkey % 90 AS DOUBLE)*CAST(0.5 AS DOUBLE) AS arm_angle",
)

PITCH_VIEW_FROM = (
    "FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey\n"
    "JOIN nation h ON h.n_nationkey=c.c_nationkey JOIN nation a ON a.n_nationkey=(c.c_nationkey + 1 + o.o_orderkey % 24) % 25\n"
    "JOIN part p ON p.p_partkey=l.l_partkey"
)

LOOKUP_VIEW_SQL = (
    "SELECT CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS key_mlbam, "
    "concat(' ',split_part(p_name,' ',1)) AS name_first, split_part(p_name,' ',2) AS name_last FROM part\n"
    "UNION ALL SELECT CAST(10000000 + s_suppkey AS VARCHAR), NULL, concat(s_name,' ') FROM supplier\n"
    "UNION ALL SELECT CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 40 = 1 THEN p_brand END, NULL FROM part WHERE p_partkey % 20 = 1"
)


def pitch_view_sql() -> str:
    """The pitch projection as one SELECT statement (for the SQL oracle)."""
    return "SELECT " + ",\n ".join(PITCH_VIEW_COLUMNS) + "\n" + PITCH_VIEW_FROM


# Read schemas of the driver tables used here (declared, so no footer-inference job per read).
DRIVER_SCHEMAS: dict[str, str] = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in DRIVER_SCHEMAS:
        return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pitch rows (landing shape, without y/m/d) from the driver tables.

    Plain inner equi-joins; Catalyst prunes every table to the columns the
    projection uses and picks broadcasts for small dimensions.  The narrow line
    items meet their parts first, and are then dealt by the game key, at every size,
    so that the joins run in parallel however few row groups there are, and windows and
    aggregates by game find their rows together instead of shuffling wide ones.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = lambda n: read_table(spark, sf_dir, n)
    l, o, c, h, a, p = (t("lineitem").alias("l"), t("orders").filter(F.col("o_orderkey").isNotNull()).alias("o"), t("customer").alias("c"),
                        t("nation").alias("h"), t("nation").alias("a"), t("part").alias("p"))
    # Orders meet their customers before the line items: a shuffle of orders by customer is one of few, narrow rows.
    games = (
        o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey"))
        .join(h, F.col("h.n_nationkey") == F.col("c.c_nationkey"))
        .join(a, F.col("a.n_nationkey") == (F.col("c.c_nationkey") + 1 + F.col("o.o_orderkey") % 24) % 25)
    )
    lines = l.join(p, F.col("p.p_partkey") == F.col("l.l_partkey")).repartition(parts, "l.l_orderkey")
    joined = lines.join(games, F.col("l.l_orderkey") == F.col("o.o_orderkey"))
    return joined.selectExpr(*PITCH_VIEW_COLUMNS)


def pitch_keys_superset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``game_pk`` of every line item: a superset of the pitch rows (the view's
    inner joins and silver's filter only remove rows), read from one table."""
    return read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("game_pk"))


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person register rows (all strings) from ``part`` and ``supplier``."""
    part = read_table(spark, sf_dir, "part")
    supplier = read_table(spark, sf_dir, "supplier")
    people = part.select(
        F.when(F.col("p_partkey") % 50 == 0, F.lit(None)).otherwise(F.col("p_partkey").cast("string")).alias("key_mlbam"),
        F.concat(F.lit(" "), F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))).alias("name_first"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("name_last"),
    )
    vendors = supplier.select(
        (F.lit(10000000) + F.col("s_suppkey")).cast("string").alias("key_mlbam"),
        F.lit(None).cast("string").alias("name_first"),
        F.concat(F.col("s_name"), F.lit(" ")).alias("name_last"),
    )
    # Ids that occur twice, some of them without any name.
    again = part.filter(F.col("p_partkey") % 20 == 1).select(
        F.col("p_partkey").cast("string").alias("key_mlbam"),
        F.when(F.col("p_partkey") % 40 == 1, F.col("p_brand")).alias("name_first"), F.lit(None).cast("string").alias("name_last"))
    return people.unionByName(vendors).unionByName(again)
