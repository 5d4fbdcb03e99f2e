"""A run keeps no more of its wide rows on disk than it still reads."""

import os
import time

import pytest
from pyspark.sql import functions as F

from martline import fixtures as fx
from martline.operators import enrich, keys
from martline.plans import etl, star
from martline.plans.queries import POSTCODE_RADIUS_KM
from martline.session import SHUFFLE_CLEANUP, scratch_path, shuffles_removed

LISTINGS = [(i, "der Hund und die Katze" if i % 3 else "the dog and the cat", float(i % 7), None if i % 5 == 0 else 1.0, i % 2 == 0)
            for i in range(40)] + [(None, None, None, None, True), (1, "der Hund und die Katze", 1.0, 1.0, False)]


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in dirs for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def left(spark, before):
    """Shuffle files that were not there before; Spark removes them in the background."""
    for _ in range(50):
        found = shuffle_files(spark) - before
        if not found:
            break
        time.sleep(0.2)
    return found


@pytest.fixture()
def listings(spark):
    return spark.createDataFrame(LISTINGS, "id int, t string, latitude double, longitude double, wanted boolean")


def rows(df):
    return sorted(df.collect(), key=str)


def test_numbered_rows_leave_no_shuffle_files(spark, listings, tmp_path):
    before = shuffle_files(spark)
    keys.tag_rows(listings, ["wanted"], ["id"], f"{tmp_path}/tagged", ["t"])
    assert not left(spark, before)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_the_setting_is_put_back(spark):
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    try:
        with pytest.raises(KeyError), shuffles_removed(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
            raise KeyError
        assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


def test_an_enriched_run_removes_the_rows_it_wrote_for_lookups(spark, sf_small, monkeypatch):
    paths = []
    monkeypatch.setattr(etl, "scratch_path", lambda spark, name: paths.append(scratch_path(spark, name)) or paths[-1])
    enrichment = star.Enrichment(fx.title_memo(spark, sf_small), fx.postcode_points(spark, sf_small), POSTCODE_RADIUS_KM)
    raw = fx.raw_listings(spark, sf_small).where("src = 'city00'")
    tables = etl.run(spark, raw, fx.source_registry(spark, sf_small), scratch_path(spark, "removed"), enrichment=enrichment, register=False)
    assert len(paths) == 1 and not os.path.exists(paths[0].removeprefix("file:"))
    assert tables["listing"].where("listingTitle LIKE 'Nice house%'").count() > 0


def test_rows_that_are_not_looked_up_are_not_shuffled(spark, listings):
    """The same rows from a broadcast and from a shuffle; in this, rows that want nothing stand in a branch without a join."""
    points = spark.createDataFrame([("A", 1.0, 1.0), ("B", 5.0, 1.0)], "postcode string, lat double, lon double")
    memo = spark.createDataFrame([("der Hund und die Katze", "en:1")], "source_text string, translated string")
    cells = spark.createDataFrame([("1.000,1.000", "C"), ("3.000,1.000", None)], "cell string, postcode string")
    lookups = {
        "nearest": lambda n: enrich.nearest_postcode(listings, points, 200.0, only=F.col("wanted"), max_broadcast_rows=n),
        "translated": lambda n: enrich.translate_memo(listings, "t", memo, only=F.col("wanted"), max_broadcast_rows=n),
        "new column": lambda n: enrich.translate_memo(listings, "t", memo, out="en", only=F.col("wanted"), max_broadcast_rows=n),
        "cells": lambda n: enrich.memo_postcode(listings, cells, F.col("wanted"), "code", max_broadcast_rows=n)}
    for name, lookup in lookups.items():
        once, split = lookup(1_000_000), lookup(0)
        assert rows(split) == rows(once) and split.columns == once.columns and split.dtypes == once.dtypes, name
        plan = split._jdf.queryExecution().optimizedPlan().toString().split("\n")
        assert plan[0].startswith("Union") and sum("Join" in line for line in plan) == 1, name
        assert "Union" not in once._jdf.queryExecution().optimizedPlan().toString(), name
