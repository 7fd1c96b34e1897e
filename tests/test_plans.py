"""Plan shape of the registered queries: what must hold at scale."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _plan(spark, name):
    return entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_python_udf_no_cross_join(spark, name):
    plan = _plan(spark, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["zone_hotspots", "zone_statistics", "word_count", "hourly_trends",
                                  "noise_grouping_sets", "location_analysis", "summary_view"])
def test_partial_aggregation_before_shuffle(spark, name):
    plan = _plan(spark, name)
    assert "partial_" in plan, f"{name} has no map-side partial aggregate"


def test_grouping_sets_single_scan(spark):
    plan = _plan(spark, "noise_grouping_sets")
    assert "Expand" in plan
    assert plan.count("FileScan parquet") == 1


def test_scans_read_only_used_columns(spark):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", _plan(spark, "zone_hotspots"))
    assert schemas == ["user_id:bigint,value:double"]
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", _plan(spark, "monthly_trends"))
    assert schemas == ["o_totalprice:double,o_orderdate:timestamp_ntz"]


def test_filters_reach_the_scan(spark):
    plan = _plan(spark, "monthly_trends")
    assert re.search(r"PushedFilters: \[IsNotNull\(o_totalprice\)\]", plan)


def test_sort_is_range_partitioned_on_name_and_record(spark):
    plan = _plan(spark, "sort_by_name")
    assert re.search(r"rangepartitioning\(name#\d+ ASC NULLS FIRST, record#\d+ ASC NULLS FIRST", plan)


def test_topk_is_take_ordered(spark):
    for name in ("zone_hotspots", "zone_hour_day", "word_frequency", "top_zones", "sample_high_noise"):
        assert "TakeOrderedAndProject" in _plan(spark, name), name


def test_hourly_map_is_one_aggregate(spark):
    plan = _plan(spark, "zone_hourly_stats")
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
