import pytest
from pyspark.sql import functions as F

from conftest import rows
from pitchlake.operators.lookup_join import fits_in_memory, resolve_names


def _frames(spark):
    fact = spark.createDataFrame([(1, 10, 20), (2, 11, None), (3, None, 20), (4, 99, 21)],
                                 "k int, batter long, pitcher long")
    dim = spark.createDataFrame([(10, "Ten"), (11, "Eleven"), (20, "Twenty"), (21, "TwentyOne")],
                                "player_id long, player_name string")
    return fact, dim


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_resolve_names_broadcast_and_shuffle_agree(spark, threshold):
    fact, dim = _frames(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = rows(resolve_names(fact, dim, {"batter": "batter", "pitcher": "pitcher"}))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [(1, "Ten", "Twenty"), (2, "Eleven", None), (3, None, "Twenty"), (4, None, "TwentyOne")]


def test_null_ids_match_no_register_id(spark):
    fact = spark.range(5000).select(F.col("id").alias("k"), F.lit(None).cast("long").alias("batter"))
    ids = spark.range(-4097, 4097).select(F.col("id").alias("player_id"), F.lit("x").alias("player_name"))
    dim = ids.union(spark.createDataFrame([(None, "nobody")], "player_id long, player_name string"))
    assert resolve_names(fact, dim, {"batter": "batter"}).filter("batter IS NOT NULL").count() == 0
    negative = spark.createDataFrame([(1, -3)], "k long, batter long")
    assert rows(resolve_names(negative, dim, {"batter": "batter"})) == [(1, "x")]


def test_resolve_names_keep_ids(spark):
    fact, dim = _frames(spark)
    out = resolve_names(fact, dim, {"batter": "batter"}, keep_ids=True)
    assert out.columns == ["k", "batter", "batter_id", "pitcher"]


def test_no_strategy_is_forced_and_no_job_runs_while_planning(spark):
    fact, dim = _frames(spark)
    plan = resolve_names(fact, dim, {"batter": "batter"})._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan


def test_a_dimension_that_fits_is_broadcast_whatever_the_threshold(spark):
    fact, dim = _frames(spark)
    dim = dim.union(spark.createDataFrame([(None, "nobody")], "player_id long, player_name string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = resolve_names(fact, dim, {"batter": "batter", "pitcher": "pitcher"}, broadcast=True)
        assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == [(1, "Ten", "Twenty"), (2, "Eleven", None), (3, None, "Twenty"), (4, None, "TwentyOne")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fits_in_memory_counts_rows_and_names(spark):
    dim = spark.createDataFrame([(1, "abcd"), (2, None), (None, "nobody")], "player_id long, player_name string")
    assert fits_in_memory(dim, most=116) and not fits_in_memory(dim, most=115)
    assert fits_in_memory(dim.limit(0), most=0)
