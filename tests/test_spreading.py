"""Narrow rows are dealt out by their number before they are made wide, and wide projections are compiled in pieces."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martline import fixtures as fx
from martline.functions.text import strip_symbols
from martline.operators.schema import apply_mapping
from martline.plans import queries
from martline.session import tasks_for

CUSTOMERS = [(i, i % 3, Decimal(i)) for i in range(1, 9)]


@pytest.fixture()
def tables(spark, tmp_path):
    """Twenty thousand orders, of one hot customer, of none and of others; a customer twice."""
    orders = spark.range(20_000).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 9).alias("o_custkey"),
        F.lit("1.50").cast("decimal(14,2)").alias("o_totalprice"), F.lit("2020-01-01").cast("date").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"))
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([*CUSTOMERS, CUSTOMERS[1], (None, 1, Decimal(0))], "c_custkey long, c_nationkey int, c_acctbal decimal(14,2)"
                          ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, f"N{i}") for i in range(3)], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    return str(tmp_path)


def rows(df):
    return sorted(df.collect(), key=str)


def test_tasks_grow_with_the_rows(spark, tables):
    orders = spark.read.parquet(f"{tables}/orders.parquet")
    assert tasks_for(orders, 1_000) == 20
    assert tasks_for(orders) == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("bound", [250_000, 3])
def test_listings_are_the_same_dealt_out_by_customer_or_not(spark, tables, monkeypatch, bound):
    """Broadcast customers, or both sides by customer: the rows of the plain SQL, and as many tasks as were asked for."""
    monkeypatch.setattr(fx, "BROADCAST_CUSTOMERS", bound)
    monkeypatch.setattr(fx, "tasks_for", lambda df: tasks_for(df, 1_000))
    got = fx.dirty_listings(spark, tables)
    assert got.rdd.getNumPartitions() == 20
    plain = spark.sql(fx.DIRTY_LISTINGS_SQL, orders_copies=fx.orders_copies(spark.read.parquet(f"{tables}/orders.parquet")),
                      customer=spark.read.parquet(f"{tables}/customer.parquet"), nation=spark.read.parquet(f"{tables}/nation.parquet"))
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


def test_wide_projections_stay_out_of_whole_stage_code(spark, tables):
    plan = apply_mapping(fx.raw_listings(spark, tables))._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" in plan


def test_symbols_of_texts_beyond_ascii_only(spark):
    texts = ["plain", "", None, "é☀", "家", "\U0001F3E0x", "\x7f"]
    got = spark.createDataFrame([(t,) for t in texts], "c string").select(strip_symbols("c")).collect()
    assert [r[0] for r in got] == ["plain", "", None, "é ", "家", " x", "\x7f"]


def test_drops_are_chosen_before_rows_are_made_wide(spark, tables):
    """Both drops of ``source_headers`` together hold every row once, and each computes wide rows of its own only."""
    raw, second = fx.raw_listings(spark, tables), queries._second_drop()
    plan = raw.where(second)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Belle maison") < plan.index("Join") < plan.index("xxhash64")
    first, other = raw.where(~second).count(), raw.where(second).count()
    assert first + other == raw.count() and min(first, other) > 0.4 * raw.count()


def test_a_task_makes_at_most_sixty_thousand_orders_wide(spark, tables):
    """Wide rows are about 1 KB each: what a task holds, groups or writes stays near 60 MB.  Landing tasks take more orders."""
    assert tasks_for(spark.range(900_000)) == 15
    assert fx.raw_listings(spark, tables, 1_000).rdd.getNumPartitions() == 20
    assert queries.LANDED_ROWS_PER_TASK == 300_000
