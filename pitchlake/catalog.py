"""Query catalogue: each entry is a Spark job over the driver tables, with an
equivalent SQL text for an independent check in DuckDB.

Spark side: library operators on DataFrames read from ``sf_dir``.
SQL side: plain ANSI SQL over the driver tables (views ``lineitem``,
``orders``, …), the pitch-shaped inputs inlined as CTEs.  Column names and
types are aligned (integer widths cast explicitly in SQL).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.operators.sequence import sequence_index
from pitchlake.plans import analysis, gold, silver
from pitchlake.schemas import (
    BARREL_LABEL,
    GAME_TYPE_LABELS,
    IN_ZONE_LABELS,
    LAUNCH_SPEED_ANGLE_LABELS,
    PASS_THROUGH_COLUMNS,
    PITCH_GROUPS,
    POOR_CONTACT_LABELS,
    RENAMES,
    SWING_PATTERN,
    UNIT_SPECS,
    ZONE_LABELS,
)
from pitchlake.sources import fixtures

# Parameters of the analysis queries on the fixture.  Pitcher × pitch type ×
# season groups there hold at most 4-5 pitches (the source analysis uses 50
# and 1000 on real seasons), so the thresholds are scaled down to keep the
# results non-empty: 242 and 30 candidate rows at sf0.01.
MIN_SAMPLE = 2
DOMINANCE_MIN_PITCHES = 1
DOMINANCE_SEASON = 1997
TOP_K = 20
# Rows per bucket of the hot-game query (the fixture's hot game has about 20,000 at sf0.01).
HOT_BUCKET_ROWS = 1000

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------------------
# Spark side: shared inputs
# ---------------------------------------------------------------------------


def _pitches(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.pitches(spark, sf)


def _silver(spark: SparkSession, sf: str, index: bool = True) -> DataFrame:
    # Games are counted on lineitem (a superset of the pitch rows) instead of
    # recomputing the five-table view.
    return silver.silver_base(_pitches(spark, sf), index=index,
                              sizes_from=fixtures.pitch_keys_superset(spark, sf) if index else None)


def _players(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_players(fixtures.lookup(spark, sf))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    # Gold and analysis never read idx_game_pitch, so it is not computed here.
    return silver.enrich(_silver(spark, sf, index=False), _players(spark, sf))


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return gold.game_summary(_enriched(spark, sf))


def _yearly(spark: SparkSession, sf: str) -> DataFrame:
    return gold.pitcher_yearly(_enriched(spark, sf))


# ---------------------------------------------------------------------------
# SQL side: shared inputs as CTEs
# ---------------------------------------------------------------------------


def _sql_str(v: object) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _sql_case(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {_sql_str(k) if isinstance(k, str) else k} THEN {_sql_str(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def _sql_in(values) -> str:
    return "(" + ", ".join(_sql_str(v) for v in values) + ")"


def _silver_select_sql() -> str:
    cols = ["game_pk", "CAST(game_date AS DATE) AS date"]
    cols += [c for c in PASS_THROUGH_COLUMNS[1:] if c != "processed_timestamp"]
    cols += [f"round(CAST({s.source} AS DOUBLE) * {s.factor!r}, 2) AS {s.output}" for s in UNIT_SPECS]
    cols += [
        f"{_sql_case('game_type', GAME_TYPE_LABELS)} AS game_type",
        f"{_sql_case('launch_speed_angle', LAUNCH_SPEED_ANGLE_LABELS)} AS launch_speed_angle",
        f"{_sql_case('zone', ZONE_LABELS)} AS pitch_zone_catcher_view",
        "CASE WHEN inning_topbot = 'Top' THEN away_team WHEN inning_topbot = 'Bot' THEN home_team END AS batting_team",
        "CASE WHEN inning_topbot = 'Top' THEN home_team WHEN inning_topbot = 'Bot' THEN away_team END AS fielding_team",
    ]
    cols += [f"{src} AS {dst}" for src, dst in RENAMES.items()]
    cols += ["CAST(trunc(spin_axis) AS INTEGER) AS spin_axis_degree", "CAST(arm_angle AS DOUBLE) AS pitch_arm_angle"]
    return ",\n  ".join(cols)


def _avg2(x: str) -> str:
    """Exact average of a two-decimal measure, rounded half away from zero to 2 places."""
    return f"CAST(round(CAST(avg(CAST({x} AS DECIMAL(18,2))) AS DECIMAL(18,9)), 2) AS DOUBLE)"


CTE_PITCHES = "pitches AS (\n" + fixtures.pitch_view_sql() + "\n)"
CTE_LOOKUP = "lookup AS (\n" + fixtures.LOOKUP_VIEW_SQL + "\n)"
CTE_SILVER_UNNUMBERED = (
    "silver0 AS (SELECT\n  " + _silver_select_sql() + "\nFROM pitches WHERE game_type NOT IN ('S', 'E'))"
)
CTE_SILVER = (
    "silver AS (SELECT *, CAST(row_number() OVER (PARTITION BY game_pk ORDER BY at_bat_number, pitch_number) AS INTEGER)"
    " AS idx_game_pitch FROM silver0)"
)
CTE_PLAYERS = (
    "players AS (SELECT player_id, max(player_name) AS player_name FROM ("
    "SELECT TRY_CAST(split_part(key_mlbam, '.', 1) AS BIGINT) AS player_id, "
    "concat_ws(' ', trim(name_first), trim(name_last)) AS player_name FROM lookup WHERE key_mlbam IS NOT NULL) "
    "GROUP BY player_id)"
)
CTE_ENRICHED = (
    "enriched AS (SELECT s.* REPLACE (b.player_name AS batter, p.player_name AS pitcher) FROM silver s "
    "LEFT JOIN players b ON s.batter = b.player_id LEFT JOIN players p ON s.pitcher = p.player_id)"
)
_GROUP_COUNTS_SQL = ",\n  ".join(
    f"count(CASE WHEN pitch_name IN {_sql_in(names)} THEN 1 END) AS n_{g}" for g, names in PITCH_GROUPS.items())
CTE_GAME_BASE = (
    "game_base AS (SELECT *, CASE WHEN home_score > away_score THEN home_team WHEN away_score > home_score THEN away_team ELSE 'Tie' END AS winner,"
    " CASE WHEN home_score < away_score THEN home_team WHEN away_score < home_score THEN away_team ELSE 'Tie' END AS loser FROM ("
    "SELECT game_pk, min(date) AS date, min(game_type) AS game_type, min(home_team) AS home_team, min(away_team) AS away_team,"
    " max(home_score) AS home_score, max(away_score) AS away_score FROM enriched GROUP BY game_pk))"
)
CTE_TEAM_STATS = (
    "team_stats AS (SELECT game_pk, fielding_team,\n  count(pitch_number) AS pitch_count,\n  "
    f"{_avg2('pitcher_release_speed_kmh')} AS pitch_avg_speed_kmh,\n  "
    "count(CASE WHEN events = 'strikeout' THEN 1 END) AS field_strikeout_count,\n  "
    "count(CASE WHEN events = 'walk' THEN 1 END) AS walk_allowed_count,\n  "
    "count(CASE WHEN events = 'hit_by_pitch' THEN 1 END) AS field_hit_by_pitch_count,\n  "
    f"{_GROUP_COUNTS_SQL},\n  "
    "count(CASE WHEN events LIKE '%fielders_choice%' THEN 1 END) AS fielders_choice_count,\n  "
    "count(CASE WHEN events = 'single' THEN 1 END) AS hit_single,\n  "
    "count(CASE WHEN events = 'double' THEN 1 END) AS hit_double,\n  "
    "count(CASE WHEN events = 'triple' THEN 1 END) AS hit_triple,\n  "
    "count(CASE WHEN events = 'home_run' THEN 1 END) AS hit_homerun,\n  "
    f"{_avg2('launch_speed_kmh')} AS hit_avg_launch_speed,\n  "
    f"{_avg2('bat_speed_kmh')} AS hit_avg_bat_speed\n"
    "FROM enriched WHERE pitcher_release_speed_kmh IS NOT NULL GROUP BY game_pk, fielding_team)"
)
CTE_SUMMARY = (
    "summary AS (SELECT g.*,\n"
    "  h.pitch_avg_speed_kmh AS home_pitch_avg_speed, h.field_strikeout_count AS home_pitch_k, h.pitch_count AS home_pitch_count,\n"
    "  h.n_fastball AS home_pitch_fastball, h.n_breaking AS home_pitch_breaking, h.n_offspeed AS home_pitch_offspeed,\n"
    "  h.hit_homerun AS away_hit_homerun, h.hit_avg_launch_speed AS away_hit_avg_launch_speed, h.hit_avg_bat_speed AS away_hit_avg_bat_speed,\n"
    "  a.pitch_avg_speed_kmh AS away_pitch_avg_speed, a.field_strikeout_count AS away_pitch_k, a.pitch_count AS away_pitch_count,\n"
    "  a.n_fastball AS away_pitch_fastball, a.n_breaking AS away_pitch_breaking, a.n_offspeed AS away_pitch_offspeed,\n"
    "  a.hit_homerun AS home_hit_homerun, a.hit_avg_launch_speed AS home_hit_avg_launch_speed, a.hit_avg_bat_speed AS home_hit_avg_bat_speed\n"
    "FROM game_base g LEFT JOIN team_stats h ON g.game_pk = h.game_pk AND g.home_team = h.fielding_team\n"
    "LEFT JOIN team_stats a ON g.game_pk = a.game_pk AND g.away_team = a.fielding_team)"
)
CTE_FLAGS = (
    "flags AS (SELECT *, CAST(year(date) AS INTEGER) AS season,\n"
    "  events = 'single' AS is_single, events = 'double' AS is_double, events = 'triple' AS is_triple, events = 'home_run' AS is_hr,\n"
    "  events IN ('strikeout', 'strikeout_double_play') AS is_k, events IN ('walk', 'intent_walk') AS is_bb,\n"
    f"  description LIKE '%swinging%' AS is_whiff, regexp_matches(description, {_sql_str(SWING_PATTERN)}) AS is_swing,\n"
    f"  launch_speed_angle = {_sql_str(BARREL_LABEL)} AS is_barrel, launch_speed_angle IN {_sql_in(POOR_CONTACT_LABELS)} AS is_poor_contact,\n"
    f"  pitch_zone_catcher_view IN {_sql_in(IN_ZONE_LABELS)} AS is_zone_in\n"
    "FROM enriched)"
)


def _flag_sum(flag: str) -> str:
    return f"CAST(sum(coalesce(CAST({flag} AS INTEGER), 0)) AS BIGINT)"


CTE_YEARLY_COUNTS = (
    "yearly_counts AS (SELECT season, pitcher, fielding_team, pitch_name,\n"
    "  count(idx_game_pitch) AS pitch_count,\n"
    f"  {_avg2('pitcher_release_speed_kmh')} AS avg_velocity, {_avg2('spin_axis_degree')} AS avg_spin_axis,\n"
    f"  {_avg2('pitch_ball_move_x_cm_catcher_view')} AS avg_break_x, {_avg2('pitch_ball_move_z_cm_catcher_view')} AS avg_break_z,\n"
    f"  {_flag_sum('is_zone_in')} AS zone_in_count, {_flag_sum('is_whiff')} AS whiff_count, {_flag_sum('is_swing')} AS swing_count,\n"
    f"  {_flag_sum('is_single')} AS single_count, {_flag_sum('is_double')} AS double_count, {_flag_sum('is_triple')} AS triple_count,\n"
    f"  {_flag_sum('is_hr')} AS hr_count, {_flag_sum('is_barrel')} AS barrel_count, {_flag_sum('is_poor_contact')} AS poor_contact_count\n"
    "FROM flags GROUP BY season, pitcher, fielding_team, pitch_name)"
)


def _rate(num: str, den: str) -> str:
    return f"round(CASE WHEN {den} > 0 THEN {num} / {den} ELSE 0.0 END, 5)"


CTE_YEARLY = (
    "yearly AS (SELECT *,\n"
    "  round(sqrt(pow(avg_break_x, 2) + pow(avg_break_z, 2)), 2) AS total_break,\n"
    f"  {_rate('whiff_count', 'swing_count')} AS whiff_rate,\n"
    f"  {_rate('barrel_count', 'pitch_count')} AS barrel_rate,\n"
    f"  {_rate('poor_contact_count', 'pitch_count')} AS poor_contact_rate,\n"
    f"  {_rate('zone_in_count', 'pitch_count')} AS zone_rate,\n"
    f"  {_rate('(single_count + double_count * 2 + triple_count * 3 + hr_count * 4)', 'pitch_count')} AS slugging_per_pitch\n"
    "FROM yearly_counts)"
)

_CTE_ORDER = ("pitches", "lookup", "silver0", "silver", "players", "enriched", "game_base", "team_stats",
              "summary", "flags", "yearly_counts", "yearly")
_CTES = {
    "pitches": (CTE_PITCHES, ()),
    "lookup": (CTE_LOOKUP, ()),
    "silver0": (CTE_SILVER_UNNUMBERED, ("pitches",)),
    "silver": (CTE_SILVER, ("silver0",)),
    "players": (CTE_PLAYERS, ("lookup",)),
    "enriched": (CTE_ENRICHED, ("silver", "players")),
    "game_base": (CTE_GAME_BASE, ("enriched",)),
    "team_stats": (CTE_TEAM_STATS, ("enriched",)),
    "summary": (CTE_SUMMARY, ("game_base", "team_stats")),
    "flags": (CTE_FLAGS, ("enriched",)),
    "yearly_counts": (CTE_YEARLY_COUNTS, ("flags",)),
    "yearly": (CTE_YEARLY, ("yearly_counts",)),
}


def with_ctes(body: str, *needs: str) -> str:
    """Prefix ``body`` with the CTEs it needs (and theirs), in dependency order."""
    wanted: set[str] = set()

    def visit(n: str) -> None:
        if n not in wanted:
            wanted.add(n)
            for d in _CTES[n][1]:
                visit(d)

    for n in needs:
        visit(n)
    parts = [_CTES[n][0] for n in _CTE_ORDER if n in wanted]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


# ---------------------------------------------------------------------------
# The catalogue
# ---------------------------------------------------------------------------

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


_KEYS = ["game_pk", "at_bat_number", "pitch_number"]


@register("competitive_only", with_ctes(
    "SELECT game_pk, at_bat_number, pitch_number, game_type FROM pitches WHERE game_type NOT IN ('S', 'E')", "pitches"))
def q_competitive_only(spark, sf):
    return silver.competitive_only(_pitches(spark, sf)).select(*_KEYS, "game_type")


@register("unit_conversion", with_ctes(
    "SELECT game_pk, at_bat_number, pitch_number, "
    + ", ".join(f"round(CAST({s.source} AS DOUBLE) * {s.factor!r}, 2) AS {s.output}" for s in UNIT_SPECS)
    + " FROM pitches", "pitches"))
def q_unit_conversion(spark, sf):
    from pitchlake.functions.units import convert_units
    return _pitches(spark, sf).select(*_KEYS, *convert_units())


@register("code_labels", with_ctes(
    "SELECT game_pk, at_bat_number, pitch_number, "
    f"{_sql_case('game_type', GAME_TYPE_LABELS)} AS game_type, "
    f"{_sql_case('launch_speed_angle', LAUNCH_SPEED_ANGLE_LABELS)} AS launch_speed_angle, "
    f"{_sql_case('zone', ZONE_LABELS)} AS pitch_zone_catcher_view FROM pitches", "pitches"))
def q_code_labels(spark, sf):
    return _pitches(spark, sf).select(*_KEYS, *silver.code_labels())


@register("side_resolution", with_ctes(
    "SELECT game_pk, at_bat_number, pitch_number, "
    "CASE WHEN inning_topbot = 'Top' THEN away_team WHEN inning_topbot = 'Bot' THEN home_team END AS batting_team, "
    "CASE WHEN inning_topbot = 'Top' THEN home_team WHEN inning_topbot = 'Bot' THEN away_team END AS fielding_team "
    "FROM pitches", "pitches"))
def q_side_resolution(spark, sf):
    from pitchlake.functions.labels import resolve_sides
    return _pitches(spark, sf).select(*_KEYS, *resolve_sides())


@register("sequence_index", with_ctes(
    "SELECT game_pk, at_bat_number, pitch_number, idx_game_pitch FROM silver", "silver"))
def q_sequence_index(spark, sf):
    return _silver(spark, sf).select(*_KEYS, "idx_game_pitch")


_HOT_GAME = "CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_orderkey END"


@register("sequence_hot_game", (
    f"SELECT l_orderkey, l_linenumber, {_HOT_GAME} AS game_pk, CAST(row_number() OVER (PARTITION BY {_HOT_GAME}"
    " ORDER BY l_partkey * 10000 + l_suppkey, l_linenumber, l_orderkey) AS INTEGER) AS idx_game_pitch FROM lineitem"))
def q_sequence_hot_game(spark, sf):
    """One game holds a third of all rows; small buckets, so that it is numbered in many of them."""
    rows = fixtures.read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(_HOT_GAME).alias("game_pk"),
        (F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("at_bat_number"))
    return sequence_index(rows, ["game_pk"], ["at_bat_number", "l_linenumber", "l_orderkey"],
                          rows_per_bucket=HOT_BUCKET_ROWS).drop("at_bat_number")


@register("silver_base", with_ctes("SELECT * FROM silver", "silver"))
def q_silver_base(spark, sf):
    return _silver(spark, sf)


@register("silver_players", with_ctes("SELECT player_id, player_name FROM players", "players"))
def q_silver_players(spark, sf):
    return _players(spark, sf).select("player_id", "player_name")


@register("scd2_columns", with_ctes(
    "SELECT player_id, CAST(NULL AS DATE) AS end_date, TRUE AS is_current FROM players", "players"))
def q_scd2_columns(spark, sf):
    return _players(spark, sf).select("player_id", "end_date", "is_current")


@register("resolve_names", with_ctes(
    "SELECT game_pk, at_bat_number, pitch_number, batter, pitcher, fielder_2 FROM enriched", "enriched"))
def q_resolve_names(spark, sf):
    return _enriched(spark, sf).select(*_KEYS, "batter", "pitcher", "fielder_2")


@register("unmatched_names", with_ctes(
    "SELECT 'batter' AS role, count(*) - count(batter) AS unmatched FROM enriched "
    "UNION ALL SELECT 'pitcher' AS role, count(*) - count(pitcher) AS unmatched FROM enriched", "enriched"))
def q_unmatched_names(spark, sf):
    e = _enriched(spark, sf)
    from pitchlake.operators.reshape import stack
    counts = e.agg(*[F.count_if(F.col(r).isNull()).alias(r) for r in ("batter", "pitcher")])
    return stack(counts, [{"role": F.lit(r), "unmatched": F.col(r)} for r in ("batter", "pitcher")])


@register("game_base", with_ctes("SELECT * FROM game_base", "game_base"))
def q_game_base(spark, sf):
    return gold.game_base(_enriched(spark, sf))


@register("team_game_stats", with_ctes("SELECT * FROM team_stats", "team_stats"))
def q_team_game_stats(spark, sf):
    return gold.team_game_stats(_enriched(spark, sf))


@register("pitch_categories", with_ctes(
    "SELECT game_pk, fielding_team, n_fastball, n_breaking, n_offspeed FROM team_stats", "team_stats"))
def q_pitch_categories(spark, sf):
    return gold.team_game_stats(_enriched(spark, sf)).select(
        "game_pk", "fielding_team", *[f"n_{g}" for g in PITCH_GROUPS])


@register("game_summary", with_ctes("SELECT * FROM summary", "summary"))
def q_game_summary(spark, sf):
    return _summary(spark, sf)


@register("outcome_flags", with_ctes(
    "SELECT game_pk, at_bat_number, pitch_number, season, is_single, is_double, is_triple, is_hr, is_k, is_bb,"
    " is_whiff, is_swing, is_barrel, is_poor_contact, is_zone_in FROM flags", "flags"))
def q_outcome_flags(spark, sf):
    return gold.with_flags(_enriched(spark, sf)).select(
        *_KEYS, "season", "is_single", "is_double", "is_triple", "is_hr", "is_k", "is_bb",
        "is_whiff", "is_swing", "is_barrel", "is_poor_contact", "is_zone_in")


@register("pitcher_yearly_counts", with_ctes("SELECT * FROM yearly_counts", "yearly_counts"))
def q_pitcher_yearly_counts(spark, sf):
    return gold.pitcher_yearly_counts(_enriched(spark, sf))


@register("pitcher_yearly", with_ctes("SELECT * FROM yearly", "yearly"))
def q_pitcher_yearly(spark, sf):
    return _yearly(spark, sf)


@register("min_sample", with_ctes(f"SELECT * FROM yearly WHERE pitch_count > {MIN_SAMPLE}", "yearly"))
def q_min_sample(spark, sf):
    return analysis.min_sample(_yearly(spark, sf), MIN_SAMPLE)


@register("dominance_top20", with_ctes(
    "SELECT *, round(raw_stuff * whiff_rate * (1.5 - slugging_per_pitch), 2) + 0.0 AS dominance_score FROM ("
    "SELECT *, avg_velocity * 0.4 + total_break * 0.6 AS raw_stuff FROM yearly "
    f"WHERE pitch_name = '4-Seam Fastball' AND pitch_count > {DOMINANCE_MIN_PITCHES} AND season = {DOMINANCE_SEASON}) "
    "ORDER BY dominance_score DESC NULLS LAST, season ASC NULLS FIRST, pitcher ASC NULLS FIRST, "
    f"fielding_team ASC NULLS FIRST, pitch_name ASC NULLS FIRST LIMIT {TOP_K}", "yearly"))
def q_dominance_top20(spark, sf):
    return analysis.dominance(_yearly(spark, sf), "4-Seam Fastball", DOMINANCE_MIN_PITCHES, DOMINANCE_SEASON, TOP_K)


@register("pitch_mix", with_ctes(
    "SELECT team, fastball, breaking, offspeed, total_count,"
    " round(fastball / total_count * 100, 2) AS fastball_pct,"
    " round(breaking / total_count * 100, 2) AS breaking_pct,"
    " round(offspeed / total_count * 100, 2) AS offspeed_pct FROM ("
    "SELECT team, CAST(sum(fastball) AS BIGINT) AS fastball, CAST(sum(breaking) AS BIGINT) AS breaking,"
    " CAST(sum(offspeed) AS BIGINT) AS offspeed, CAST(sum(total) AS BIGINT) AS total_count FROM ("
    "SELECT home_team AS team, home_pitch_fastball AS fastball, home_pitch_breaking AS breaking,"
    " home_pitch_offspeed AS offspeed, home_pitch_count AS total FROM summary UNION ALL "
    "SELECT away_team, away_pitch_fastball, away_pitch_breaking, away_pitch_offspeed, away_pitch_count FROM summary"
    ") GROUP BY team)", "summary"))
def q_pitch_mix(spark, sf):
    return analysis.pitch_mix(_summary(spark, sf))


@register("result_stack", with_ctes(
    "SELECT game_pk, CASE WHEN winner = home_team THEN home_pitch_avg_speed ELSE away_pitch_avg_speed END AS pitch_speed,"
    " CASE WHEN winner = home_team THEN home_hit_avg_launch_speed ELSE away_hit_avg_launch_speed END AS launch_speed,"
    " 'Winner' AS result FROM summary UNION ALL "
    "SELECT game_pk, CASE WHEN loser = home_team THEN home_pitch_avg_speed ELSE away_pitch_avg_speed END,"
    " CASE WHEN loser = home_team THEN home_hit_avg_launch_speed ELSE away_hit_avg_launch_speed END,"
    " 'Loser' FROM summary", "summary"))
def q_result_stack(spark, sf):
    return analysis.stack_results(_summary(spark, sf))


@register("home_advantage", with_ctes(
    "SELECT game_pk, date, home_team, home_hit_avg_bat_speed - away_hit_avg_bat_speed AS bat_speed_diff,"
    " home_score - away_score AS score_diff,"
    " CASE WHEN winner = home_team THEN 'Win' ELSE 'Loss' END AS home_result FROM summary", "summary"))
def q_home_advantage(spark, sf):
    return analysis.home_advantage(_summary(spark, sf))


@register("efficiency_by_result", with_ctes(
    "SELECT is_win, round(avg(hit_efficiency), 6) AS avg_efficiency, round(avg(home_hit_avg_bat_speed), 6) AS avg_bat_speed"
    " FROM (SELECT CASE WHEN home_hit_avg_bat_speed <> 0 THEN home_hit_avg_launch_speed / home_hit_avg_bat_speed END"
    " AS hit_efficiency, CASE WHEN winner = home_team THEN 1 ELSE 0 END AS is_win, home_hit_avg_bat_speed FROM summary)"
    " GROUP BY is_win", "summary"))
def q_efficiency_by_result(spark, sf):
    return analysis.efficiency_by_result(_summary(spark, sf))


# Sources, sinks, incremental and streaming queries register themselves on import.
from pitchlake import catalog_io as _catalog_io  # noqa: E402,F401
