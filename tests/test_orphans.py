"""Orphans are counted by one anti join, dealt out by the number of fact rows."""

import re

import pytest

from martline.plans import star

OTHERS = [k for d, k in star.FACT_KEYS.items() if d != "host"]


@pytest.fixture()
def tables(spark):
    """Keys that are missing, null, shared by fact rows, twice in a dimension, or in another dimension only."""
    facts = [(f"a{i}", "0" if i < 60 else f"h{i}") for i in range(100)] + [(None, None), (None, "0")]
    fact = spark.createDataFrame([(*[key] * len(OTHERS), host) for key, host in facts], ", ".join(f"{c} string" for c in [*OTHERS, "hostId"]))
    dims = {d: spark.createDataFrame([(f"a{i}",) for i in range(100)], f"{k} string") for d, k in star.FACT_KEYS.items()}
    dims["host"] = spark.createDataFrame([(f"h{i}",) for i in range(60, 100)] + [(None,)], "hostId string")
    dims["review"] = spark.createDataFrame([(f"a{i}",) for i in range(10, 100)] * 2 + [(None,)], "reviewId string")
    return dims | {"booking": fact}


def test_missing_and_null_keys_are_orphans(spark, tables):
    got = {r.dimension: r.orphans for r in star.orphans(tables).collect()}
    # Hosts: the shared "0" of 61 rows and the null one; reviews: ten missing keys and two null ones.
    assert got == {d: 2 for d in star.FACT_KEYS} | {"host": 62, "review": 12}


def test_tasks_follow_the_fact_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(star, "tasks_for", lambda df: 7)
    plan = star.orphans(tables)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(dimension#\d+, key#\d+, 7\), REPARTITION_BY_NUM", plan)) == 1
    assert "SortMergeJoin" not in plan
