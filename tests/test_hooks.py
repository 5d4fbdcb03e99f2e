"""Services inside the run, and the schema report."""

import tempfile

from pyspark.sql import functions as F

from martline import fixtures as fx
from martline.operators.quality import merged_report, schema_report
from martline.plans import etl, star
from martline.plans.queries import POSTCODE_RADIUS_KM
from martline.session import scratch_path


def test_a_run_asks_the_services_once(spark, sf_small):
    raw = fx.raw_listings(spark, sf_small).where("src = 'city00'")  # both flags are set
    log, base = tempfile.mkdtemp(prefix="martline-services-"), scratch_path(spark, "services")

    def note(name, values):
        with open(f"{log}/{name}", "a") as file:
            file.write("".join(f"{v}\n" for v in values))

    def translate(values):
        note("texts", values)
        return "en " + values

    def geocode(values):
        note("cells", values)
        return values.map(lambda v: '{"results":[{"address_components":[{"long_name":"H%s","types":["postal_code"]}]}]}' % v.split(".")[0])

    enrichment = star.Enrichment(fx.title_memo(spark, sf_small).where("source_text LIKE 'Belle%'"), fx.postcode_points(spark, sf_small),
                                 POSTCODE_RADIUS_KM, translate=translate, texts_path=f"{base}/texts", geocode=geocode, cells_path=f"{base}/cells")
    asked = []
    for n in range(2):
        tables = etl.run(spark, raw, fx.source_registry(spark, sf_small), f"{base}/out", enrichment=enrichment, register=False)
        asked.append([open(f"{log}/{x}").read().split("\n")[:-1] for x in ("texts", "cells")])
    assert asked[0] == asked[1] and all(len(x) == len(set(x)) > 0 for x in asked[0])
    titles = {r[0] for r in tables["listing"].select("listingTitle").collect()}
    assert not any(t.startswith(("Belle", "東京")) for t in titles) and any(t.startswith("en 東京") for t in titles)
    assert any(t.startswith("Nice house") for t in titles) and any(t.startswith("Plain room") for t in titles)
    codes = [r.zipcode for r in tables["location"].where("latitude <> 0 AND longitude <> 0").collect()]
    assert any(c.startswith("H") for c in codes) and any(c.startswith("P") for c in codes) and "000000" not in codes


def test_schema_report_types_and_merging(spark):
    rows = [("a", "1", "1.5", "2020-01-02", "t", None, "x", " "), ("a", " 2 ", "3", "2021-12-31", "f", None, "1", ""),
            ("b", "1", "1.5", "2020-13-01", "t", "7", "t", None), ("b", None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "src string, i string, d string, day string, f string, n string, `it\'s x` string, e string")
    got = {(r.src, r.column_name): r.type for r in schema_report(df).collect()}
    assert [got["a", c] for c in df.columns[1:]] == ["int", "decimal", "date", "flag", "empty", "text", "empty"]
    assert got["b", "day"] == "text" and got["b", "n"] == "int" and got["b", "it\'s x"] == "flag"
    parts = [schema_report(df.where(F.col("src") == s)) for s in ("a", "b")]
    assert sorted(map(tuple, merged_report(parts).collect())) == sorted(map(tuple, schema_report(df).collect()))
    whole = {r.column_name: r.type for r in merged_report(parts, by=None).collect()}
    assert [whole[c] for c in df.columns[1:]] == ["int", "decimal", "text", "flag", "int", "text", "empty"]
