"""Plan checks: no nested-loop joins, no cartesian products, no Python evaluation in any query."""

import pytest

import __spark_entry__ as entry
from closetops.registry import QUERIES

from conftest import SF_SMALL

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, f"{name}: {bad}"


def test_flagship_prunes_and_broadcasts_only_calendar(spark):
    df = entry.queries()["q_ageing_bins"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # only the columns the log needs are read from the events file
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
