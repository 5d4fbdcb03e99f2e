"""Increments: nothing lost or repeated, constant plans, published versions."""

import pytest
from pyspark.sql import functions as F

from martline import fixtures as fx
from martline.plans import etl, increments, star
from martline.plans.queries import FIRST_DROP, POSTCODE_RADIUS_KM
from martline.session import scratch_path
from martline.sources import versions


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark, sf_small):
    """A written copy, so that each batch reads a file."""
    path = scratch_path(spark, "raw")
    fx.raw_listings(spark, sf_small).where("src IN ('city00', 'city01')").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def sources(spark, sf_small):
    return fx.source_registry(spark, sf_small)


def test_older_batches_again_change_nothing(spark, raw, sources):
    out = scratch_path(spark, "again")
    etl.run_increment(spark, raw.where(FIRST_DROP), sources, out, 0)
    after = etl.run_increment(spark, raw, sources, out, 1)
    want = {n: rows(t) for n, t in after.items()}
    version = versions.read_manifest(spark, out).version
    again = etl.run_increment(spark, raw.where(FIRST_DROP), sources, out, 0)
    assert {n: rows(t) for n, t in again.items()} == want
    assert versions.read_manifest(spark, out).version == version
    with pytest.raises(ValueError, match="batch 1 is known"):
        etl.run_increment(spark, raw.where(FIRST_DROP), sources, out, 1)


def test_batches_in_any_order_equal_a_full_run_but_for_ids(spark, raw, sources):
    full, out = scratch_path(spark, "full"), scratch_path(spark, "order")
    want = etl.run(spark, raw, sources, full, register=False)
    part = F.pmod(F.xxhash64("`Listing Title`"), F.lit(3))
    for n in (2, 0, 1):
        got = etl.run_increment(spark, raw.where((part == n) | (part == 0)), sources, out, n)
    ids = [c for c in want["booking"].columns if c.endswith("Id") and c not in ("hostId", "propertyId")]
    for name in want:
        keep = [c for c in want[name].columns if c not in ids and c != "checkInOutId"]
        assert rows(got[name].select(*keep)) == rows(want[name].select(*keep)), name
    assert got["booking"].select("bookingId").distinct().count() == want["booking"].count()
    assert {r[1] for r in rows(star.orphans(got))} == {0}


def test_a_batch_that_dies_is_in_no_version_and_its_retry_is_whole(spark, raw, sources, monkeypatch):
    out = scratch_path(spark, "dies")
    first = etl.run_increment(spark, raw.where(FIRST_DROP), sources, out, "a")
    want = {n: rows(t) for n, t in first.items()}
    write, done = versions.write_part, []

    def dying(*args, **kwargs):
        if len(done) == 5:
            raise OSError("lost")
        done.append(args[2])
        return write(*args, **kwargs)

    monkeypatch.setattr(versions, "write_part", dying)
    with pytest.raises(OSError):
        etl.run_increment(spark, raw, sources, out, "b")
    monkeypatch.undo()
    assert {n: rows(t) for n, t in versions.read_tables(spark, out).items()} == want
    second = etl.run_increment(spark, raw, sources, out, "b")
    known = {r[0] for r in first["booking"].select("bookingId").collect()}
    ids = [r[0] for r in second["booking"].select("bookingId").collect()]
    assert known < set(ids) and len(ids) == len(set(ids)) == star.distinct_listings(raw).count()


def test_a_full_run_that_dies_leaves_the_tables_before(spark, raw, sources, monkeypatch):
    out = scratch_path(spark, "full-dies")
    few = raw.where("src = 'city00'")
    want = {n: rows(t) for n, t in etl.run(spark, few, sources, out, register=False).items()}
    write, done = versions.write_part, []

    def dying(*args, **kwargs):
        if len(done) == 4:
            raise OSError("lost")
        done.append(args[2])
        return write(*args, **kwargs)

    monkeypatch.setattr(versions, "write_part", dying)
    with pytest.raises(OSError):
        etl.run(spark, raw.where("src = 'city01'"), sources, out, register=False)
    monkeypatch.undo()
    assert len(want) == 8 and {n: rows(t) for n, t in versions.read_tables(spark, out).items()} == want
    etl.run(spark, raw.where("src = 'city01'"), sources, out, register=False)
    assert {n: rows(t) for n, t in versions.read_tables(spark, out, version=1).items()} == want
    assert {r[0] for r in versions.read_tables(spark, out)["booking"].select("src").distinct().collect()} == {"city01"}


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_plans_do_not_grow_with_the_number_of_batches(spark, raw, sources, monkeypatch):
    out, plans = scratch_path(spark, "many"), []
    write = versions.write_part

    def watched(df, base, name, *args, **kwargs):
        plans[-1][name] = scans(df)
        return write(df, base, name, *args, **kwargs)

    monkeypatch.setattr(versions, "write_part", watched)
    few = raw.where("src = 'city00'")
    for n in range(4):
        plans.append({})
        etl.run_increment(spark, few.where(F.pmod(F.xxhash64("`Listing Title`"), F.lit(4)) == n), sources, out, n)
    assert plans[1] == plans[2] == plans[3]
    tables = versions.read_tables(spark, out)
    assert len(versions.read_manifest(spark, out).tables["booking"].parts) == 4 and all(scans(t) == 1 for t in tables.values())


def test_only_digests_of_earlier_wide_rows_are_read(spark, raw, sources, monkeypatch):
    out, read, asked = scratch_path(spark, "digests"), versions.read_table, []

    def watched(spark, base, name, table, columns=None, with_part=False):
        asked.append((name, columns))
        return read(spark, base, name, table, columns, with_part)

    etl.run_increment(spark, raw.where(FIRST_DROP), sources, out, 0)
    monkeypatch.setattr(increments.versions, "read_table", watched)
    etl.run_increment(spark, raw, sources, out, 1)
    assert [c for n, c in asked if n == "_wide"] == [["_digest"]]


def test_increments_take_enrichment_hash_ids_and_csv(spark, raw, sources, sf_small):
    enrichment = star.Enrichment(fx.title_memo(spark, sf_small), fx.postcode_points(spark, sf_small), POSTCODE_RADIUS_KM)
    full, out = scratch_path(spark, "enriched-full"), scratch_path(spark, "enriched-increments")
    options = {"enrichment": enrichment, "ids": "hash", "fmt": "csv", "compression": "gzip", "register": False}
    want = etl.run(spark, raw, sources, full, **options)
    etl.run_increment(spark, raw.where(FIRST_DROP), sources, out, 0, **options)
    got = etl.run_increment(spark, raw, sources, out, 1, **{**options, "register": True})
    for name in want:
        assert rows(got[name]) == rows(want[name]), name
    assert spark.sql("SELECT count(*) FROM booking").first()[0] == want["booking"].count()


def test_enrichment_reads_the_raw_rows_once(spark, raw, sources, sf_small):
    enrichment = star.Enrichment(fx.title_memo(spark, sf_small), fx.postcode_points(spark, sf_small), POSTCODE_RADIUS_KM)
    plan = star.cleaned_rows(raw, sources, enrichment=enrichment)._jdf.queryExecution().optimizedPlan().toString()
    # The rows stand in the plan once, as the written copy; the other relations are the memo, points and flags.
    assert plan.count("Relation [src#") == 1 and "Airbnb Property ID#" not in plan


def test_a_stream_feeds_increments(spark, raw, sources):
    """Two drops, a crash after the first is published but before the stream knows, and a stream begun anew."""
    from martline.sources import files
    from martline.streaming.incremental import stream_increments
    base = scratch_path(spark, "stream")
    one = raw.where("src = 'city00'").drop("src")
    columns, first = one.columns, F.pmod(F.xxhash64("Listing Title"), F.lit(2)) == 0

    def take(checkpoint, **options):
        stream_increments(spark, "city00", f"{base}/in/*", columns, sources, f"{base}/star", f"{base}/{checkpoint}", **options)
        return versions.read_tables(spark, f"{base}/star")

    files.write_raw(one.where(first), f"{base}/in/d1")
    etl_run, calls = increments.run_increment, []

    def dies_after(*args, **kwargs):
        etl_run(*args, **kwargs)
        calls.append(1)
        raise OSError("lost after publication")

    increments.run_increment = dies_after
    try:
        with pytest.raises(Exception, match="lost after publication"):
            take("ckpt")
    finally:
        increments.run_increment = etl_run
    begun = rows(versions.read_tables(spark, f"{base}/star")["booking"])
    assert calls == [1] and rows(take("ckpt")["booking"]) == begun
    files.write_raw(one.where(~first), f"{base}/in/d2")
    done = take("ckpt")["booking"]
    assert done.count() == star.distinct_listings(raw.where("src = 'city00'")).count() and set(begun) < set(rows(done))
    assert rows(take("ckpt")["booking"]) == rows(done)
    # A stream that has lost its checkpoint sends all files as its batch 0, whose rows were others: nothing is taken for them.
    with pytest.raises(Exception, match="batch city00/0 is known with other rows"):
        take("other")
    # Under a name of its own it brings nothing new.
    stream_increments(spark, "city00", f"{base}/in/*", columns, sources, f"{base}/star", f"{base}/third", ledger_name="again")
    assert rows(versions.read_tables(spark, f"{base}/star")["booking"]) == rows(done)
