"""Sources whose files have other headers, and many sources at once."""

import logging

import pytest

from martline.session import local_path, scratch_path
from martline.sources import files


def put(base, name, text):
    import os
    path = f"{local_path(base)}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as file:
        file.write(text)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select("src", *[f"`{c}`" for c in columns]).collect()), key=repr)


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_of_a_source_may_differ_in_order_and_number_of_columns(spark, multi_line):
    base = scratch_path(spark, "orders")
    put(base, "a/one.csv", "x,y\n1,2\n")
    put(base, "a/deep/two.csv", "y,x\n20,10\n")
    put(base, "a/three [b]{c} d%20.csv", "\n\nx,z\n100,300\n")
    put(base, "a/four.csv", '"x","y"\n1000,2000\n')
    put(base, "b/one.csv", "Y\r\n7\r\n")
    got = files.read_sources(spark, {"a": f"{base}/a", "b": f"{base}/b"}, multi_line)
    assert rows(got, "x", "y", "z") == sorted(
        [("a", "1", "2", None), ("a", "10", "20", None), ("a", "100", None, "300"), ("a", "1000", "2000", None), ("b", None, "7", None)], key=repr)


def test_headers_with_breaks_repeats_and_gaps(spark):
    base = scratch_path(spark, "odd")
    put(base, "a/one.csv", '"long\nname","say ""x""",x\n"1\n1",2,3\n')
    put(base, "b/one.csv", "x,x,\n4,5,6\n")
    put(base, "c/one.csv", "a`b,x\n8,9\n")
    got = files.read_sources(spark, {s: f"{base}/{s}" for s in "abc"})
    by_src = {r.src: r.asDict() for r in got.collect()}
    assert (by_src["a"]["long\nname"], by_src["a"]['say "x"'], by_src["a"]["x"]) == ("1\n1", "2", "3")
    assert [by_src["b"][c] for c in ("x0", "x1", "_c2")] == ["4", "5", "6"]
    assert (by_src["c"]["a`b"], by_src["c"]["x"]) == ("8", "9")


def test_files_and_sources_without_lines(spark, caplog):
    base = scratch_path(spark, "empty")
    put(base, "a/none.csv", "")
    put(base, "a/blank.csv", "\n\n")
    put(base, "a/header.csv", "x,y\n")
    put(base, "a/row.csv", "x,y\n1,\n")
    put(base, "b/none.csv", "")
    with caplog.at_level(logging.WARNING):
        got = files.read_sources(spark, {"a": f"{base}/a", "b": f"{base}/b"})
    assert rows(got, "x", "y") == [("a", "1", None)] and "b" in caplog.text
    with pytest.raises(ValueError, match="header line"):
        files.read_sources(spark, {"b": f"{base}/b"})
    with pytest.raises(ValueError, match="no sources"):
        files.read_sources(spark, {})


def test_many_sources_cost_the_jobs_of_few(spark):
    base = scratch_path(spark, "many")
    for i in range(60):
        put(base, f"s{i:02d}/one.csv", f"x,c{i % 3}\n{i},{i}\n")

    def jobs(n):
        spark.sparkContext.setJobGroup(f"headers-{n}", "headers")
        try:
            df = files.read_sources(spark, {f"s{i:02d}": f"{base}/s{i:02d}" for i in range(n)})
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers-{n}")), df

    few, _ = jobs(2)
    many, df = jobs(60)
    assert many == few
    assert rows(df, "x") == [(f"s{i:02d}", str(i)) for i in range(60)]


def test_only_the_beginning_of_a_file_is_read_for_its_header(spark):
    base = scratch_path(spark, "large")
    put(base, "a/one.csv", "x,y\n" + "1,2\n" * 3_000_000)
    found = files.source_headers(spark, {"a": f"{base}/a"}, {"a": True})
    assert [tuple(r.header) for r in found.collect()] == [("x", "y")]
    assert found.rdd.getNumPartitions() == 1
