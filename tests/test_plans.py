"""Plans of the heavier queries: how often they read tables, and what they don't contain."""

from __future__ import annotations

import pytest

from tidewatch import registry

SF = "/root/testdata/sf0.001"


def plan_of(spark, name):
    df = registry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "scans"), [("g13_g14_bridge_backtest", 15), ("j20_j21_scaled_conformal", 15), ("j21_conformal_days", 30), ("j26_quantiles_of_today", 15), ("j14_diebold_mariano", 8)])
def test_tables_are_read_a_few_times(spark, name, scans):
    plan = plan_of(spark, name)
    assert plan.count("FileScan") <= scans, plan.count("FileScan")
    assert "CartesianProduct" not in plan


def test_pools_are_no_rows(spark):
    """Windows of residuals are taken in blocks: nothing is exploded but a row's two blocks."""
    plan = plan_of(spark, "j17_j24_pool_quantiles")
    assert plan.count("Generate") == 1 and "FlatMapCoGroupsInPandas" in plan


def test_no_copied_rows_are_broadcast(spark):
    """g11 dealt each order to fourteen folds and Spark, going by the size of the file, broadcast them all."""
    spark.conf.set("spark.sql.maxBroadcastTableSize", "4m")
    try:
        assert registry.queries()["g11_linear_walkforward"](spark, "/root/testdata/sf0.01").count() > 2000
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
