"""Shapes the physical plans must keep at any scale."""

import re

import pytest

from uptide.plans.catalog import QUERIES

# These fit models, run streams or write tables while the frame is built.
EAGER = {n for n in QUERIES if n.startswith(("train_", "stream_"))} | {"model_forecast", "linear_regression_fit"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text
    assert not re.search(r"Exchange RoundRobinPartitioning|CollectLimit", text)


def test_filters_and_columns_reach_the_scan(spark, sf):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(QUERIES["period_filter"](spark, sf))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThanOrEqual(l_shipdate" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_orderkey", "l_linenumber", "l_shipdate"}


def test_top_rows_are_limited_before_the_shuffle(spark, sf):
    assert plan(QUERIES["top_compounds_with_others"](spark, sf)).count("WindowGroupLimit") >= 1


def test_large_sides_are_not_forced_to_broadcast(spark, sf):
    """With broadcasting off every join still has a plan, so no hint depends on a size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("prescription", "wear_features", "operation_windows", "monthly_spine", "only_new_rows"):
            assert "Broadcast" not in plan(QUERIES[name](spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
