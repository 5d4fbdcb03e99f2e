"""WARC archives of pages, and a global index merged from their locally sorted runs.

Records are built and written by Spark (one text row a record, ended by the
record separator), so archives go to any file system that Spark writes.
Reading back, each archive's captures form a run sorted by URL key and
time.  Sampled splitters cut all runs at the same keys, and each task merges
its segments of the runs with a loser tree; a hot URL is cut by time.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.archives import LoserTree, payload_of, records, sha1_hex, url_key
from martline.llm.common import packed, shuffle_partitions, written
from martline.session import scratch_path

#: Payloads from this size on are stored once.
MIN_REVISIT_BYTES = 1000
#: Largest payload of a tier of archives, and how many records one of them holds, which bounds an
#: archive at 128 MB or one record.
TIERS = ((1 << 16, 2000), (1 << 22, 32), (1 << 62, 1))
#: Capture time of pages without one: this epoch second plus their id, within ten years.
FIRST_CAPTURE, CAPTURE_SPAN = 1_704_067_200, 315_360_000

#: Captures that a task merges, about.
RANGE_ROWS = 100_000

_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = T.StructType([
    T.StructField("url_key", T.StringType()), T.StructField("captured", T.StringType()),
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("archive", T.StringType()), T.StructField("record_offset", T.LongType()),
    T.StructField("record_length", T.LongType())])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", time_col: str | None = None, compress: bool = False) -> None:
    """Writes one record per row as WARC/1.1 archives under ``path``.

    Of equal payloads of ``MIN_REVISIT_BYTES`` or more, the row with the
    largest id is a response (each such row, if its id repeats) and the others are
    revisits that refer to it; smaller ones are all responses.  Null payloads
    are empty, a null URL is left out, a null id is smaller than any other and
    read back as null; a row without a time (null, or no time column) has one
    that follows from its id.  Blanks and control characters in a URL are
    percent-encoded.  Repeated rows are records of their own; an empty table
    writes no archive; other columns are not archived.
    """
    row = F.col("_row")
    given = F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce(row.getField(id_col).cast("long"), F.lit(0)), F.lit(CAPTURE_SPAN)))
    rows = packed(pages).select(
        row.getField(id_col).cast("long").alias("_id"), row.getField(url_col).cast("string").alias("_url"),
        F.coalesce(row.getField(payload_col).cast("string"), F.lit("")).alias("_payload"),
        _utc(F.coalesce(row.getField(time_col).cast("timestamp"), given) if time_col else given).alias("_date"))
    rows = rows.withColumns({"_bytes": F.octet_length("_payload").cast("long"), "_digest": F.sha1("_payload")})
    large = F.col("_bytes") >= MIN_REVISIT_BYTES
    groups = written(rows.filter(large).groupBy("_digest").agg(F.count("*").alias("_n"), F.max("_id").alias("_keep"))
                     .filter("_n > 1"), "warc-copies")
    # Groups over a quarter of a partition's share of rows are at most 4 a partition: these are broadcast,
    # and their rows spread over the join of the rest.
    total, largest = rows.agg(F.count("*"), F.coalesce(F.max("_bytes"), F.lit(0))).first()
    share = max(1024, -(-total // (4 * shuffle_partitions(pages.sparkSession))))
    hot = groups.filter(F.col("_n") > share).select("_digest", F.col("_keep").alias("_hot_keep"), F.lit(True).alias("_hot"))
    rest = groups.filter(F.col("_n") <= share).select(F.col("_digest").alias("_join"), "_keep", F.lit(True).alias("_copied"))
    rows = (rows.join(F.broadcast(hot), "_digest", "left")
            .withColumn("_join", F.when(F.col("_hot") | ~large, F.concat(F.lit("-"), F.xxhash64("_id", "_url")))
                        .otherwise(F.col("_digest")))
            .join(rest, "_join", "left"))
    keep = F.coalesce("_hot_keep", "_keep")
    shared = large & (F.coalesce("_hot", F.lit(False)) | F.coalesce("_copied", F.lit(False)))
    out = rows.select("_bytes", _record(shared & ~F.col("_id").eqNullSafe(keep), keep).alias("value"))
    above = -1
    for most, number in TIERS:
        if above < max(largest, 0):
            tier = out.filter((F.col("_bytes") > above) & (F.col("_bytes") <= most)).select("value")
            tier.write.mode("append").option("lineSep", _END).option("maxRecordsPerFile", number).option(
                "compression", "gzip" if compress else "none").text(path)
        above = most


def _utc(time: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _record(revisit: Column, keep: Column) -> Column:
    """The record's text, without the separator that ends it."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("_bytes").cast("string"), F.lit(_END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("_payload")))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    safe = F.when(F.col("_url").rlike("[\\x00-\\x20\\x7f]"),
                  reduce(lambda url, c: F.replace(url, F.lit(chr(c)), F.lit(f"%{c:02X}")), [*range(0x21), 0x7F], F.col("_url"))
                  ).otherwise(F.col("_url"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise("response")),
        line("WARC-Record-ID", page(F.col("_id"))), line("WARC-Date", F.col("_date")), line("WARC-Target-URI", safe),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_PROFILE)), line("WARC-Refers-To", page(keep)))).otherwise(""),
        line("X-Payload-Length", F.col("_bytes").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_END), block)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (columns ``CAPTURE``), sorted inside each archive by URL key, time and id.

    A record without a URL has a null one and an empty key, one without an id
    a null one; a folder without archives gives no rows.  Digests and sizes of responses are computed from the payload that was
    read; a response whose header disagrees raises.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_runs, CAPTURE)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0), batch.column(1)):
            data = content.as_py()
            archive = name.as_py()
            if archive.endswith(".gz"):
                data = gzip.decompress(data)
            found = [_capture(archive, *r) for r in records(data)]
            yield _batch(sorted(found, key=_order))


def _batch(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(CAPTURE.names, r)) for r in found], schema=_ARROW)


_ARROW = pa.schema([(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in CAPTURE])


def _order(capture: tuple) -> tuple:
    """URL key, time, id (null first), then the record's place."""
    key, time, page = capture[0], capture[1], capture[2]
    return (key, time, page is not None, page or 0, capture[8], capture[9])


def _capture(archive: str, offset: int, length: int, head: dict[str, str], block: bytes) -> tuple:
    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
    if head["warc-type"] == "response":
        payload = payload_of(block)
        if (sha1_hex(payload), len(payload)) != (digest, size):
            raise ValueError(f"payload of {head['warc-record-id']} in {archive} does not match its header")
    url = head.get("warc-target-uri")
    return (url_key(url), head["warc-date"], _page(head["warc-record-id"]), url, head["warc-type"],
            _page(head.get("warc-refers-to")), size, digest, archive, offset, length)


def _page(urn: str | None) -> int | None:
    number = urn[len("<urn:page:"):-1] if urn else "none"
    return None if number == "none" else int(number)


def merged_index(captures: DataFrame) -> DataFrame:
    """All captures in global order of URL key, time and id, numbered by ``position`` from 0.

    Splitters come from Spark's range partitioning on that order, with a
    range for every ``RANGE_ROWS`` captures, so a task holds the segments of
    one range of bounded size, however many captures there are or one URL
    has.  Equal captures are ordered by archive and place.  ``captures`` is
    read three times: pass a written table.  No captures give an empty index.
    """
    ranges = max(shuffle_partitions(captures.sparkSession), -(-captures.count() // RANGE_ROWS))
    cut = captures.repartitionByRange(ranges, "url_key", "captured", "page_id", "archive", "record_offset")
    runs = cut.sortWithinPartitions("archive", "url_key", "captured", "page_id", "record_offset")
    schema = T.StructType([*CAPTURE, T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType())])
    merged = written(runs.mapInArrow(_merge, schema), "warc-index")
    # One row per partition of the range sort.
    before = merged.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)).alias("_base"))
    return merged.join(F.broadcast(before), "_part").select(
        *CAPTURE.names, (F.col("_base") + F.col("_at")).alias("position"))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the runs of one range; rows arrive run by run."""
    rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
    runs = [iter(list(g)) for _, g in groupby(rows, key=lambda r: r[8])]
    part, out, at = TaskContext.get().partitionId(), [], 0
    schema = _ARROW.append(pa.field("_part", pa.int32())).append(pa.field("_at", pa.int64()))
    for capture in LoserTree(runs, _order):
        out.append(dict(zip(schema.names, (*capture, part, at))))
        at += 1
        if len(out) == 10_000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  time_col: str | None = None, path: str | None = None) -> DataFrame:
    """Writes archives (below the shared checkpoint folder unless ``path`` is given), reads them back and merges their index.

    An empty table gives an empty index.  Repeated rows are archived again.  The
    index has the columns ``CAPTURE`` and ``position``; other input columns are not kept.
    """
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, url_col, payload_col, time_col)
    # Written once, so that archives are not parsed again for the sampled splitters.
    return merged_index(written(read_captures(pages.sparkSession, path), "warc-captures"))
