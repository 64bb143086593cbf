"""Plan properties the scale design relies on (final AQE plans, sf0.001)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    try:
        return plan.finalPhysicalPlan().toString()
    except Exception:  # noqa: BLE001 - not adaptive
        return plan.toString()


def _shuffles(plan: str) -> int:
    return sum(1 for l in plan.splitlines()
               if "Exchange " in l and "BroadcastExchange" not in l and "ReusedExchange" not in l
               and "SinglePartition" not in l)


@pytest.mark.parametrize("name,max_shuffles", [
    ("composition_stats_long", 2), ("composition_stats_wide", 2), ("electron_stats", 2),
    ("property_lookup", 2), ("train_test_split", 0), ("sample_by_hash", 0), ("word_count", 1),
    ("vector_assemble", 0), ("electron_shells", 0)])
def test_shuffle_budget_and_no_python(spark, name, max_shuffles):
    plan = _final_plan(entry.queries()[name](spark, SF_SMALL))
    assert _shuffles(plan) <= max_shuffles, plan
    assert "EvalPython" not in plan and "PythonUDF" not in plan


@pytest.mark.parametrize("name,exchanges", [("composition_stats_long", 4), ("composition_stats_wide", 4),
                                            ("electron_stats", 4), ("linear_ratio", 6)])
def test_no_window_above_a_shuffled_join(spark, name, exchanges):
    """As at scale, where no side is small: two exchanges for each join, two for the statistics, sorts for the joins only."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _final_plan(entry.queries()[name](spark, SF_SMALL)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = sum("SortMergeJoin" in line for line in plan)
    assert sum("Exchange hashpartitioning" in line for line in plan) <= exchanges
    assert not any(" Window" in line for line in plan) and sum("Sort [" in line for line in plan) <= 2 * joins


def test_partial_aggregation_before_shuffles(spark):
    for name in ("word_count", "composition_stats_long", "except_distinct"):
        plan = _final_plan(entry.queries()[name](spark, SF_SMALL))
        assert "partial_" in plan or "HashAggregate(keys=[o_orderkey, stratum], functions=[]" in plan, name


def test_scan_prunes_columns(spark):
    plan = _final_plan(entry.queries()["composition_stats_long"](spark, SF_SMALL))
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l and "lineitem" in l]
    assert scans and all("l_extendedprice" not in l for l in scans)


@pytest.mark.parametrize("name", ["composition_stats_normalized", "composition_stats_wide", "fitted_stats", "composition_stats_unknown_wide",
                                  "feature_pipeline", "composition_stats_float", "feature_select", "present_components",
                                  "composition_stats_subset_wide"])
def test_wide_queries_aggregate_narrow_pairs(spark, name):
    """No aggregate of the wide queries holds a row of all columns for each (entity, component)."""
    plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "pivotfirst" not in plan and "collect_list" in plan
