"""Plan shape checks: the properties that matter at scale, read from the
executed plans of the registered queries."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from sensorflow.plans.queries import QUERIES

PYTHON_NODES = re.compile(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_query_plans(spark, name):
    assert not PYTHON_NODES.search(_plan(entry_mod.queries()[name](spark, SF_SMALL)))


def test_row_local_queries_do_not_shuffle(spark):
    for name in ("extract_readings", "layout_dispatch", "to_points", "valid_coords",
                 "magnitude", "fixed_decimals", "rejects", "time_range"):
        plan = _plan(entry_mod.queries()[name](spark, SF_SMALL))
        assert "Exchange" not in plan, name


def test_filters_reach_the_scan(spark):
    plan = _plan(entry_mod.queries()["time_range"](spark, SF_SMALL))
    # (the plan text truncates long filter lists)
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), IsNotNull\(event_type\), GreaterThanOrEqual\(ts,2024-01-05T00:00\), LessThan\(ts,", plan)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_stitched_lag_uses_hash_aggregates_only(spark, monkeypatch):
    assert "Join" not in _plan(entry_mod.queries()["lag_stitched"](spark, SF_SMALL))  # short series: a plain window
    monkeypatch.setattr("sensorflow.operators.series.SPLIT_ROWS", 10)
    plan = _plan(entry_mod.queries()["lag_stitched"](spark, SF_SMALL))
    assert "SortAggregate" not in plan
    assert "partial_max_by" in plan
    # the big side is shuffled once, on (series, bucket)
    assert len(re.findall(r"Exchange hashpartitioning\(__sf_key#\d+, __sf_bucket", plan)) == 2


def test_window_aggregates_combine_before_shuffle(spark):
    plan = _plan(entry_mod.queries()["window_stats"](spark, SF_SMALL))
    assert "partial_avg" in plan and "partial_count" in plan
