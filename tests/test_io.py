"""Sources and sinks: CSV and Parquet round trips, schema drift, incremental runs."""

import math
import os
import shutil
import tempfile
import time

import pytest

from martline import fixtures as fx
from martline.session import local_path, scratch_path
from martline.sources import files
from martline.streaming.incremental import ingest_new_files, ingest_sources


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_roundtrip_with_quotes_and_newlines(spark):
    df = spark.createDataFrame([(1, 'say "hi", then\nleave', " padded "), (2, "", None)],
                               "id int, text string, pad string")
    path = scratch_path(spark, "csv-rt")
    files.write_table(df, path, fmt="csv", compression="gzip")
    back = files.read_written(spark, path, fmt="csv", schema=df.schema)
    assert rows(back) == [(1, 'say "hi", then\nleave', " padded "), (2, "", None)]


def test_files_of_one_source_must_share_a_header(spark):
    base = scratch_path(spark, "headers")
    files.write_raw(spark.createDataFrame([("1", "2")], "x string, y string"), f"{base}/one")
    files.write_raw(spark.createDataFrame([("3", "4")], "y string, x string"), f"{base}/two")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv_source(spark, base).collect()


def test_source_names_stay_text(spark):
    df = spark.createDataFrame([("a", "007"), ("b", "01")], "v string, src string")
    path = scratch_path(spark, "names")
    files.write_table(df, path, partition_by=["src"])
    assert rows(files.read_written(spark, path, schema=df.schema).select("src", "v")) == [("007", "a"), ("01", "b")]
    zone = scratch_path(spark, "zone")
    files.land_by_source(df, zone)
    assert rows(files.read_landed(spark, zone, ["v"])) == [("007", "a"), ("01", "b")]


def test_sinks_are_read_by_their_commit_logs(spark):
    from martline.streaming.incremental import read_sinks
    base = scratch_path(spark, "stray")
    files.write_raw(spark.createDataFrame([("1",)], "id string"), f"{base}/in/a/d1")
    sinks = ingest_sources(spark, {"a": (f"{base}/in/a/*", ["id"])}, f"{base}/out", f"{base}/ckpt")
    stray = f"{base}/stray"
    spark.createDataFrame([("9",)], "id string").coalesce(1).write.parquet(stray)
    part = next(f for f in os.listdir(local_path(stray)) if f.endswith(".parquet"))
    shutil.copy(f"{local_path(stray)}/{part}", f"{local_path(sinks['a'])}/{part}")
    assert rows(read_sinks(spark, sinks)) == [("a", "1")]


def test_parquet_roundtrip(spark, sf_small):
    df = fx.dirty_listings(spark, sf_small)
    path = scratch_path(spark, "pq-rt")
    files.write_table(df, path)
    assert rows(files.read_written(spark, path)) == rows(df)


def test_sources_with_different_headers(spark):
    a = spark.createDataFrame([("1", "x")], "`Airbnb Property ID` string, `Zipcode` string")
    b = spark.createDataFrame([("2",)], "`Airbnb Property ID` string")
    base = scratch_path(spark, "drift")
    files.write_table(a, f"{base}/a", fmt="csv")
    files.write_table(b, f"{base}/b", fmt="csv")
    united = files.read_sources(spark, {"a": f"{base}/a", "b": f"{base}/b"})
    assert rows(united.select("src", "Airbnb Property ID", "Zipcode")) == [("a", "1", "x"), ("b", "2", None)]


def test_landing_partitions_by_source(spark, sf_small):
    raw = fx.raw_listings(spark, sf_small)
    path = scratch_path(spark, "landing")
    files.land_by_source(raw, path)
    names = sorted(d for d in os.listdir(local_path(path)) if d.startswith("src="))
    assert names == sorted(f"src={r[0]}" for r in raw.select("src").distinct().collect())


def test_incremental_exactly_once(spark):
    cols = ["id", "val"]
    base = scratch_path(spark, "incr")
    inbox, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    files.write_raw(spark.createDataFrame([("1", "a")], "id string, val string"), f"{inbox}/d1")
    ingest_new_files(spark, f"{inbox}/*", cols, sink, ckpt)
    assert spark.read.parquet(sink).count() == 1
    ingest_new_files(spark, f"{inbox}/*", cols, sink, ckpt)
    assert spark.read.parquet(sink).count() == 1
    files.write_table(spark.createDataFrame([("2", "b"), ("3", "c")], "id string, val string"),
                      f"{inbox}/d2", fmt="csv")
    ingest_new_files(spark, f"{inbox}/*", cols, sink, ckpt)
    assert rows(spark.read.parquet(sink)) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_enrich_hook_errors_and_rate(spark):
    from martline.operators.enrich import enrich_hook

    def shaky(s):
        if (s == "boom").any():
            raise RuntimeError("service down")
        return s.str.upper()

    df = spark.createDataFrame([("a",), ("boom",), ("a",), (None,)], "t string")
    out = {r["value"]: (r["result"], r["status"]) for r in
           enrich_hook(df, "t", shaky, max_calls_per_second=1000, partitions=2).collect()}
    assert out == {"a": ("A", "ok"), "boom": (None, "error: RuntimeError")}


def test_nearest_postcode_matches_brute_force(spark):
    import math
    import random

    from martline.operators.enrich import nearest_postcode
    rnd = random.Random(7)
    pts = [(f"P{i}", rnd.uniform(-90, 90), rnd.choice([rnd.uniform(-180, 180), 179.9, -179.9])) for i in range(60)]
    qs = [(i, rnd.uniform(-90, 90), rnd.uniform(-181, 181)) for i in range(400)] + [(400, 89.99, 10.0)]
    radius = 800.0

    def hav(a, b, c, d):
        p1, p2 = math.radians(a), math.radians(c)
        x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(d) - math.radians(b)) / 2) ** 2
        return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(x)))

    expect = {}
    for i, la, lo in qs:
        cands = sorted((hav(la, lo, pla, plo), pc) for pc, pla, plo in pts)
        cands = [c for c in cands if c[0] <= radius]
        expect[i] = cands[0][1] if cands else None
    df = spark.createDataFrame(qs, "id int, latitude double, longitude double")
    points = spark.createDataFrame(pts, "postcode string, lat double, lon double")
    got = {r["id"]: r["postcode"] for r in nearest_postcode(df, points, radius).collect()}
    assert got == expect
    shuffled = nearest_postcode(df, points, radius, max_broadcast_rows=5)
    assert {r["id"]: r["postcode"] for r in shuffled.collect()} == expect
    assert sum(v is not None for v in expect.values()) > 20


def test_incremental_per_source_checkpoints(spark):
    base = scratch_path(spark, "incr-src")
    cols = ["id"]
    one = spark.createDataFrame([("1",)], "id string")
    files.write_table(one, f"{base}/in/a/d1", fmt="csv")
    files.write_table(one, f"{base}/in/b/d1", fmt="csv")
    registry = {"a": (f"{base}/in/a/*", cols), "b": (f"{base}/in/b/*", cols)}
    ingest_sources(spark, registry, f"{base}/out", f"{base}/ckpt")
    files.write_table(spark.createDataFrame([("2",)], "id string"), f"{base}/in/b/d2", fmt="csv")
    from martline.streaming.incremental import read_sinks
    sinks = ingest_sources(spark, registry, f"{base}/out", f"{base}/ckpt")
    got = rows(read_sinks(spark, sinks).select("src", "id"))
    assert got == [("a", "1"), ("b", "1"), ("b", "2")]


def test_read_with_file_lineage(spark):
    base = scratch_path(spark, "lineage")
    files.write_table(spark.createDataFrame([("1",), ("2",)], "id string").coalesce(1), f"{base}/a", fmt="csv")
    df = files.read_csv_source(spark, f"{base}/a", lineage=True)
    got = df.select("source_file").distinct().collect()
    assert len(got) == 1 and got[0][0].endswith(".csv") and "/a/" in got[0][0]


def test_hook_keeps_its_budget_and_sends_no_answered_value_again(spark):
    from martline.operators.enrich import enrich_hook
    log = tempfile.mkdtemp(prefix="martline-hook-")

    def service(values):
        with open(f"{log}/calls", "a") as file:
            file.write("".join(f"{time.time()} {v}\n" for v in values))
        if (values == "bad").any():
            raise RuntimeError("refused")
        return values.str.upper()

    df = spark.createDataFrame([(f"v{i % 120}",) for i in range(400)] + [("bad",)], "t string")
    got = {r["value"]: r["status"] for r in enrich_hook(df, "t", service, max_calls_per_second=60, partitions=1).collect()}
    assert got["bad"] == "error: RuntimeError" and sum(s == "ok" for s in got.values()) == 120
    calls = [line.split() for line in open(f"{log}/calls")]
    times = sorted(float(t) for t, _ in calls)
    # No second sees more than the budget and one slice.
    assert max(sum(t <= u < t + 1 for u in times) for t in times) <= 60 + 12
    slices_with_bad = {v for _, v in calls if sum(v == w for _, w in calls) > 1}
    assert len(slices_with_bad) <= 12  # only the values of the failing slice are sent again


def test_memo_learns_each_text_once(spark):
    from martline.operators.enrich import learn_translations, translate_memo
    path = scratch_path(spark, "memo")
    spark.createDataFrame([("le chat et les", "the cat")], "source_text string, translated string").write.parquet(path)
    log = tempfile.mkdtemp(prefix="martline-memo-")

    def service(values):
        with open(f"{log}/calls", "a") as file:
            file.write("".join(f"{v}\n" for v in values))
        return "en " + values

    df = spark.createDataFrame([("le chat et les",), ("東京の家です",), ("東京の家です",), ("the house",), ("بيت كبير",), (None,)], "t string")
    memo = learn_translations(df, "t", path, service)
    memo.count(), memo.count()
    memo = learn_translations(df, "t", path, service)
    assert sorted(open(f"{log}/calls").read().split("\n")[:-1]) == sorted(["東京の家です", "بيت كبير"])
    got = [r[0] for r in translate_memo(df, "t", memo, out="e").select("e").collect()]
    assert sorted(got, key=str) == sorted(["the cat", "en 東京の家です", "en 東京の家です", "the house", "en بيت كبير", None], key=str)


def test_nearest_postcode_in_a_dense_place(spark):
    import random

    from martline.operators.enrich import nearest_postcode
    rnd = random.Random(3)
    pts = [(f"P{i:05d}", 40 + rnd.uniform(0, 0.2), 10 + rnd.uniform(0, 0.2)) for i in range(3000)] + [("Q", 40.1, 10.1), ("A", 40.1, 10.1)]
    qs = [(i, 40 + rnd.uniform(0, 0.2), 10 + rnd.uniform(0, 0.2)) for i in range(40)] + [
        (100, 40.1, 10.1), (101, 40.1, 10.1), (102, 40.35, 10.0), (103, None, 10.0), (104, 40.0, None), (105, 80.0, 10.0)]
    got = {r["id"]: r["postcode"] for r in nearest_postcode(
        spark.createDataFrame(qs, "id int, latitude double, longitude double"),
        spark.createDataFrame(pts, "postcode string, lat double, lon double"), 50.0).collect()}

    def hav(a, b, c, d):
        x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(x)))

    assert len(got) == len(qs) and got[100] == got[101] == "A" and got[103] is got[104] is got[105] is None
    for i, la, lo in qs:
        if la is not None and lo is not None and la < 80:
            assert got[i] == min((hav(la, lo, a, b), p) for p, a, b in pts)[1]
