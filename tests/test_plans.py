"""What the physical plans must and must not hold."""

import pytest

import __spark_entry__ as entry_module
from tickloom.plans import REGISTRY, streams

STREAMS = {n for n in vars(streams) if n in entry_module.queries()}
BATCH = sorted(set(REGISTRY) - STREAMS - {"lr_fit", "lr_metrics"})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    plan = plan_of(entry_module.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "BatchEvalPython"):
        assert bad not in plan


def test_look_back_reaches_the_scan(spark, sf_dir):
    plan = plan_of(entry_module.queries()["top_symbols_3h"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan and "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


@pytest.mark.parametrize("name", ["bars_m1", "exposure", "realised_pnl", "dedup_last_wins", "depth_book"])
def test_rows_are_combined_before_the_shuffle(name, spark, sf_dir):
    plan = plan_of(entry_module.queries()[name](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_" in plan


@pytest.mark.parametrize("name", ["ticks_page", "deals_page", "latest_per_key_limit", "bars_latest_n"])
def test_pages_limit_each_key_before_the_shuffle(name, spark, sf_dir):
    plan = plan_of(entry_module.queries()[name](spark, sf_dir))
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


@pytest.mark.parametrize("name", ["quote_ffill", "margin_call_crossings", "cash_flow_history"])
def test_ordered_scans_are_one_shuffle_without_large_keys(name, spark, sf_dir):
    df = entry_module.queries()[name](spark, sf_dir)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1 and final.count("Window [") == 1


def test_bars_aggregate_by_hash_and_bounds_reach_the_scan(spark, sf_dir):
    plans = {name: plan_of(entry_module.queries()[name](spark, sf_dir)) for name in ("bars_h1", "bars_latest_n", "deals_next_page")}
    assert "SortAggregate" not in plans["bars_h1"] + plans["bars_latest_n"]
    assert "GreaterThanOrEqual(ts," in plans["bars_latest_n"] and "LessThan(ts," in plans["bars_latest_n"]
    assert "GreaterThanOrEqual(" in plans["deals_next_page"]
