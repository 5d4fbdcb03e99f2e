"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from built import query
from check_oracles import compare, duck
from martline.plans.oracle import oracles
from martline.plans.queries import QUERIES

SQL = oracles()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, con, name):
    df = query(spark, sf_small, name)
    spark_rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    duck_cols = [d[0] for d in res.description]
    msg = compare(df.columns, spark_rows, duck_cols, res.fetchall())
    assert msg is None, msg


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["src", "country", "city", "superhost", "listings", "hosts",
                          "total_revenue", "avg_revenue"]
