"""Tables laid out by join key: the fact is not shuffled to meet its locations."""

import pytest

from martline import fixtures as fx
from martline.plans import etl, star
from martline.session import scratch_path
from martline.sources import versions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark, sf_small):
    base = scratch_path(spark, "layout")
    raw = fx.raw_listings(spark, sf_small).where("src < 'city05'")
    etl.run(spark, raw, fx.source_registry(spark, sf_small), base, register=False)
    reader = spark.newSession()  # shares the catalog; joins sort and merge, as large tables do
    reader.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    # At least as many buckets as shuffle partitions, so that a laid out side is never shuffled to spread it.
    return base, reader, versions.lay_out_tables(reader, base, "martline_layout_test", 16)


def test_no_exchange_below_the_location_join(built):
    base, reader, laid = built
    plain = versions.read_tables(reader, base)
    assert plan(star.located_fact(plain["booking"], plain["location"])).count("Exchange") == 2
    joined = plan(star.located_fact(laid["booking"], laid["location"]))
    assert "SortMergeJoin" in joined and "Exchange" not in joined


def test_only_added_up_rows_are_shuffled(built):
    base, reader, laid = built
    whole = plan(star.revenue_by_city(laid["booking"], laid["location"], laid["host"]))
    # Added up per city and host, by host for the join, and the result's own grouping; the host side is not shuffled.
    assert whole.count("SortMergeJoin") == 2 and whole.count("Exchange hashpartitioning") == 3


def test_same_rows_as_the_plain_tables(built):
    base, reader, laid = built
    plain = versions.read_tables(reader, base)
    for name in versions.LAYOUT_KEYS:
        assert sorted(map(str, laid[name].collect())) == sorted(map(str, plain[name].collect()))
    a, b = (star.revenue_by_city(t["booking"], t["location"], t["host"]).collect() for t in (laid, plain))
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) > 5


def test_laid_out_again_after_a_new_run(built, spark, sf_small):
    base, reader, laid = built
    before = laid["booking"].count()
    raw = fx.raw_listings(spark, sf_small).where("src < 'city02'")
    etl.run(spark, raw, fx.source_registry(spark, sf_small), base, register=False)
    assert reader.table("martline_layout_test.booking").count() == before
    again = versions.lay_out_tables(reader, base, "martline_layout_test", 4)
    assert 0 < again["booking"].count() == versions.read_tables(reader, base)["booking"].count() < before
    with pytest.raises(ValueError, match="not published"):
        versions.lay_out_tables(reader, base, "martline_layout_test", 4, {"nothing": "id"})
