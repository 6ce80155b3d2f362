"""What the plans must and must not contain."""

import re

import pytest

import workload.queries  # noqa: F401
from workload.registry import QUERIES

from given import SF


def executed(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_day_scan_is_pushed_down_and_pruned(spark):
    plan = executed(spark, "scan_day")
    assert "GreaterThanOrEqual(ts,2024-01-10" in plan and "LessThan(ts,2024-01-11" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint>" in plan


def test_equality_scan_is_pushed_down(spark):
    plan = executed(spark, "scan_equal")
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan


@pytest.mark.parametrize(
    "name", ["revenue_by_merchant", "city_performance", "rider_ltv", "pit_login_attempts", "earthquake_daily", "scd2_rebuild"]
)
def test_no_python_no_cross_join(spark, name):
    plan = executed(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["dedup_latest", "stg_rides", "pay_fact_payments", "clean_users"])
def test_latest_row_is_limited_before_the_shuffle(spark, name):
    plan = executed(spark, name)
    assert re.search(r"WindowGroupLimit[^\n]*Partial", plan)


def test_marts_label_after_aggregating(spark):
    """The city join sits above the aggregation, so it handles one row per city and day."""
    plan = executed(spark, "city_performance")
    assert plan.index("Join [city_id") < plan.index("HashAggregate")


def test_fact_scan_reads_only_needed_columns(spark):
    plan = executed(spark, "pit_join_direct")
    assert all("props" not in line for line in plan.splitlines() if "FileScan" in line)
