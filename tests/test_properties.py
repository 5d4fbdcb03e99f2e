"""Properties of the cleaning and the star schema on the sf0.001 fixture."""

import pytest
from pyspark.sql import functions as F

from martline import fixtures as fx
from martline.config import FILL_DEFAULTS, FLAG_COLUMNS, SOURCE_COL
from martline.operators.quality import dedupe_rows, drop_common_missing, strip_symbols_all
from martline.plans import star


@pytest.fixture(scope="module")
def raw(spark, sf_small):
    return fx.raw_listings(spark, sf_small)


@pytest.fixture(scope="module")
def sources(spark, sf_small):
    return fx.source_registry(spark, sf_small)


@pytest.fixture(scope="module")
def tables(raw, sources):
    wide = star.clean_listings(raw, sources)
    return {k: v.cache() for k, v in star.star_tables(wide).items()}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dedupe_idempotent(raw):
    once = dedupe_rows(drop_common_missing(star.mapped_listings(raw)))
    assert rows(dedupe_rows(once)) == rows(once)


def test_strip_idempotent(raw):
    once = strip_symbols_all(star.mapped_listings(raw))
    assert rows(strip_symbols_all(once)) == rows(once)


def test_union_count_is_sum_of_parts(spark, raw):
    from martline.sources.files import union_sources
    names = [r[0] for r in raw.select(SOURCE_COL).distinct().collect()]
    parts = {n: raw.where(F.col(SOURCE_COL) == n).drop(SOURCE_COL) for n in names}
    united = union_sources(parts)
    assert united.count() == sum(p.count() for p in parts.values()) == raw.count()


@pytest.mark.parametrize("table", ["listing", "location", "review", "pricing", "booking", "host"])
def test_fills_leave_no_nulls(tables, table):
    cols = list(FILL_DEFAULTS[table]) + FLAG_COLUMNS.get(table, [])
    df = tables[table]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first().asDict()
    assert all(v == 0 for v in nulls.values()), nulls


def test_checkin_modes_fill(tables):
    df = tables["checkin"]
    n = df.agg(F.count_if(F.col("minimumStay").isNull())).first()[0]
    assert n == 0


def test_fact_keys_unique(tables):
    fact = tables["booking"]
    assert fact.select("bookingId").distinct().count() == fact.count()
    assert fact.select("listingId").distinct().count() == fact.count()


def test_host_dimension_one_row_per_host(tables):
    host = tables["host"]
    assert host.select("hostId").distinct().count() == host.count()


def test_no_orphans(tables):
    assert {r["dimension"]: r["orphans"] for r in star.orphans(tables).collect()} == \
        {d: 0 for d in star.FACT_KEYS}


def test_ids_stable_across_runs_and_partitionings(spark, raw, sources):
    def ids():
        wide = star.clean_listings(raw, sources)
        return rows(wide.select(SOURCE_COL, "propertyId", "listingId", "bookingId"))

    first = ids()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        second = ids()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert first == second
    assert ids() == first


def test_ids_dense_per_source(tables, raw, sources):
    wide = star.clean_listings(raw, sources)
    per_src = wide.groupBy(SOURCE_COL).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.regexp_extract("listingId", r"(\d+)$", 1).cast("long")).alias("hi"))
    assert all(r["n"] == r["hi"] for r in per_src.collect())


def test_hash_ids_need_no_shuffle(raw, sources):
    from martline.operators.keys import add_hash_ids
    from martline.operators.schema import source_constants
    df = source_constants(star.mapped_listings(raw), sources)
    plan = add_hash_ids(df, sources)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_etl_run_writes_and_registers(spark, sf_small):
    from martline.plans.etl import run
    from martline.session import scratch_path
    out = scratch_path(spark, "etl-test")
    counts = {}
    tables = run(spark, fx.raw_listings(spark, sf_small), fx.source_registry(spark, sf_small), out,
                 counts=counts)
    assert counts["raw_rows"] > counts["clean_rows"] > 0
    assert set(tables) == {"listing", "host", "location", "amenities", "review", "checkin",
                           "pricing", "booking"}
    n = spark.sql("SELECT count(*) FROM booking").first()[0]
    assert n == spark.read.parquet(f"{out}/booking").count() == counts["clean_rows"]


def test_monotonic_ids_stable_after_checkpoint(spark, raw):
    from martline.operators.keys import add_monotonic_ids
    df = add_monotonic_ids(star.mapped_listings(raw).select(SOURCE_COL, "propertyId"), "ALL")
    first, second = rows(df), rows(df)
    assert first == second
    assert df.select("listingId").distinct().count() == df.count()


def test_sequence_with_hot_null_key_matches_window(spark):
    from pyspark.sql import Window

    from martline.operators.keys import sequence_number
    data = [("s1" if i % 4 else "s2", None if i % 3 == 0 else str(i % 50), i, f"v{i % 7}") for i in range(3000)]
    df = spark.createDataFrame(data, "src string, k string, a int, b string")
    got = sequence_number(df, ["src"], ["k"], name="n", tiebreak=["a", "b"])
    h = F.md5(F.concat_ws("\x1f", F.coalesce("k", F.lit("")), F.coalesce("b", F.lit(""))))
    w = Window.partitionBy("src").orderBy(F.col("k").asc_nulls_first(), h.asc_nulls_first(),
                                          F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first())
    expect = df.select("*", F.row_number().over(w).alias("n"))
    assert rows(got) == rows(expect)


def test_etl_run_gzip_csv(spark, sf_small):
    from martline.plans.etl import run
    from martline.session import scratch_path
    out = scratch_path(spark, "etl-csv")
    tables = run(spark, fx.raw_listings(spark, sf_small), fx.source_registry(spark, sf_small), out,
                 fmt="csv", compression="gzip", register=False)
    fact = tables["booking"]
    assert fact.count() == tables["listing"].count() > 0
    assert fact.where(F.col(SOURCE_COL).isNull()).count() == 0
    assert dict(fact.dtypes)["annualRevenueLtmUSD"] == "double"


def test_fixture_exercises_every_column(raw):
    mapped = star.mapped_listings(raw)
    counts = mapped.agg(*[F.struct(F.count(c), F.count_if(F.col(c).isNull())).alias(c) for c in mapped.columns if c != SOURCE_COL])
    for c, (known, missing) in counts.first().asDict().items():
        assert known > 0 and missing > 0, c
    assert mapped.where("hostId = '0'").count() > 0


def test_unknown_source_raises(spark, raw, sources):
    fewer = sources.where("src <> 'city00'")
    for ids in ("sequence", "hash"):
        with pytest.raises(Exception, match="source not in the source table: city00"):
            star.clean_listings(raw, fewer, ids=ids).collect()


def test_hash_ids_are_unique(raw, sources):
    wide = star.clean_listings(raw, sources, ids="hash")
    assert wide.where("propertyId IS NULL").count() > 1
    assert wide.select("listingId").distinct().count() == wide.count()


def test_casts_take_numbers_only(spark):
    from martline.operators.schema import cast_text
    texts = ["7d", "7f", "NaN", "Infinity", "0x1", "1_0", "", " 1.9 ", "-2", ".5", "1e2", "3."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(cast_text(F.col("t"), "int"), cast_text(F.col("t"), "double")).collect()]
    assert got == [(None, None)] * 7 + [(1, 1.9), (-2, -2.0), (0, 0.5), (100, 100.0), (3, 3.0)]
