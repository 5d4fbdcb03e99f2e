"""Plan guards for every query of the listing library: no pair explosion, no row-at-a-time Python."""

import pytest

from built import query
from martline.plans.queries import QUERIES
# Only the external-call hook may run Python, and then as Arrow batches.
ARROW_PYTHON = {"enrich_hook"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_or_row_udf(spark, sf_small, name):
    plan = query(spark, sf_small, name)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in ARROW_PYTHON:
        assert "ArrowEvalPython" not in plan and "MapInPandas" not in plan and "PythonMapInArrow" not in plan
