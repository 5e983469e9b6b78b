"""Plan guards over every registered query (sf0.001).

Whatever the query, its physical plan must stay JVM-side and scale-safe:
no Python UDF evaluation, no cartesian or nested-loop join, no broadcast
(nothing here has a bounded side), and every final aggregate has a partial
aggregate below it.
"""

import re

import pytest

from riverwatch.plans.registry import QUERIES

from samples import SF001

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin", "BroadcastExchange", "BroadcastHashJoin")


def _executed_plan(df):
    df.collect()  # runs this DataFrame's own plan, so the AQE plan is final
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=false" not in plan
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    plan = _executed_plan(QUERIES[name](spark, SF001))
    for node in FORBIDDEN:
        assert node not in plan, (name, node)
    aggs = re.findall(r"(?:Hash|ObjectHash|SortAggregate)\w*\(keys=\[[^\]]*\], functions=\[([^\n]*)", plan)
    with_functions = [a for a in aggs if not a.startswith("]")]
    partials = [a for a in with_functions if a.startswith("partial_")]
    finals = [a for a in with_functions if not a.startswith("partial_")]
    assert len(partials) >= len(finals), (name, plan)


def test_guard_sees_aggregates(spark):
    plan = _executed_plan(QUERIES["location_stats"](spark, SF001))
    assert "partial_count(1)" in plan and re.search(r"functions=\[count\(1\)", plan)
