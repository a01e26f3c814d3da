"""Physical-plan guards: no cross products, pruned scans, one sort for the baselines."""

import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["city_kde", "city_histogram", "spatial_stats", "resolve_areas"])
def test_no_cross_products(spark, key):
    plan = _plan(entry.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_baselines_share_one_sort_and_prune_the_scan(spark):
    plan = _plan(entry.queries()["walkforward_metrics"](spark, SF_SMALL))
    assert plan.count("Window [") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
