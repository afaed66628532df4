"""Physical-plan properties: pushdown, pruning, join and aggregate strategies, no Python UDFs."""

from conftest import SF0001
from pitchlake import catalog


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_query_plan(spark):
    for name in ("silver_base", "game_summary", "pitcher_yearly", "pitch_mix", "dominance_top20", "resolve_names"):
        plan = _plan(catalog.QUERIES[name](spark, SF0001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(catalog.QUERIES["competitive_only"](spark, SF0001))
    assert "PushedFilters: [IsNotNull(o_orderkey)" in plan
    # only the columns the projection needs are read from lineitem
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>" in plan


def test_game_summary_is_hash_aggregated_without_sort_aggregate(spark):
    plan = _plan(catalog.QUERIES["game_summary"](spark, SF0001))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "BroadcastHashJoin" in plan  # names resolved by broadcast, pitches never shuffled for it


def test_top_k_plan(spark):
    assert "TakeOrderedAndProject" in _plan(catalog.QUERIES["dominance_top20"](spark, SF0001))


def test_side_stack_reads_summary_once(spark):
    plan = _plan(catalog.QUERIES["result_stack"](spark, SF0001))
    assert "Generate inline" in plan
    assert plan.count("FileScan parquet") == catalog.QUERIES["game_summary"](spark, SF0001)._jdf.queryExecution() \
        .executedPlan().toString().count("FileScan parquet")
