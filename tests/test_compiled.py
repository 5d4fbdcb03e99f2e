"""Digests of wide rows are computed outside whole-stage code."""

import re

import pytest

from martline import fixtures as fx
from martline.operators import keys
from martline.plans import increments

#: Bytecode of a method beyond which it is interpreted.
COMPILED = 8000


def largest_method(spark, df):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.PythonSQLUtils.explainString(df.select("*")._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text)))


@pytest.fixture()
def written(monkeypatch):
    """Frames as they are handed to a writer of Parquet or CSV, each written all the same."""
    seen = []
    from pyspark.sql.readwriter import DataFrameWriter
    for name in ("parquet", "csv"):
        kept = getattr(DataFrameWriter, name)

        def write(self, path, *args, _kept=kept, **options):
            seen.append(self._df)
            return _kept(self, path, *args, **options)

        monkeypatch.setattr(DataFrameWriter, name, write)
    return seen


def test_digests_of_a_drop_are_compiled(spark, sf_small, written):
    increments._drop(spark, fx.raw_listings(spark, sf_small))
    assert largest_method(spark, written[0]) < COMPILED


def test_row_hash_of_tagged_rows_stays_out_of_whole_stage_code(spark, tmp_path, written):
    df = spark.createDataFrame([("a", "k", "t")], "src string, propertyId string, title string")
    keys.tag_rows(df, ["src"], ["propertyId"], f"{tmp_path}/tagged", ["title"])
    assert re.search(r"lambdafunction\(.*md5|md5.*lambdafunction", written[0]._jdf.queryExecution().optimizedPlan().toString())


def test_digests_are_compiled_and_not_interpreted_in_a_lambda(spark, sf_small, tmp_path, written):
    df = spark.createDataFrame([("a", "k", "t")], "src string, propertyId string, title string")
    keys.tag_rows(df, ["src"], ["propertyId"], f"{tmp_path}/tagged", ["title"])
    increments._drop(spark, fx.raw_listings(spark, sf_small).limit(1))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in written]
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    for plan, digest in zip(plans, ("md5", "sha2"), strict=True):
        assert digest in plan and f"array({digest}" not in plan
