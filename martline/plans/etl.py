"""The whole ETL: raw listings -> cleaned wide frame -> eight published tables -> SQL views.

Each source is scanned once.  The cleaned wide frame is written once (Parquet,
partitioned by source, in the output folder) and the eight tables are cut
from that copy: every table reads only its own columns, and a lost executor
recomputes from the written copy rather than from the raw files.  The tables
become visible together, as a new version (``sources.versions``).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import SOURCE_COL
from ..operators.keys import add_hash_ids, add_surrogate_ids
from ..session import scratch_path
from ..sources import files, versions
from . import star
from .increments import run_increment  # noqa: F401 - the incremental form of ``run``

log = logging.getLogger(__name__)


def run(spark: SparkSession, raw: DataFrame, sources: DataFrame, out_dir: str,
        fmt: str = "parquet", compression: str | None = None, ids: str = "sequence",
        host_grain: str = "host", fact_partitions: int | None = None,
        unset: str = "null", register: bool = True,
        counts: dict[str, int] | None = None,
        enrichment: star.Enrichment | None = None, keep_versions: int = 2) -> dict[str, DataFrame]:
    """Build the star schema and publish it as a new version; return the written tables.

    ``raw`` holds the raw header columns plus ``src``; ``sources`` the
    per-source constants and id prefixes, and the flags ``translate`` and
    ``geocode`` where ``enrichment`` is given.  ``fmt="csv", compression="gzip"``
    writes the tables as the original job did; Parquet is the default.
    The wide rows are written once: the copy behind the id sequence is the
    wide zone, and ids are added on read from its small offset table.
    The distinct rows written for enrichment are removed once the wide rows are.
    Row counts before and after cleaning are observed during the jobs that
    run anyway (no extra count jobs); they are logged and, when ``counts`` is
    given, stored in it.  A run that fails before the end leaves the version
    published before as it is (``versions.read_tables``); of older ones
    ``keep_versions`` are kept in all.
    """
    base, tag = out_dir.rstrip("/"), versions.new_tag("run")
    before = versions.read_manifest(spark, base)
    if before.batches:
        raise ValueError("the folder holds increments; add to them by run_increment or take another folder")
    part = f"{versions.PART}={tag}"
    seen_raw, seen_clean = Observation("raw_rows"), Observation("clean_rows")
    raw = raw.observe(seen_raw, F.count(F.lit(1)).alias("rows"))
    distinct = scratch_path(spark, "distinct") if enrichment is not None else None
    cleaned = star.cleaned_rows(raw, sources, unset, enrichment, distinct)
    if ids == "sequence":
        wide = add_surrogate_ids(cleaned, sources, path=f"{base}/_wide/{part}", seen=seen_clean, offsets_path=f"{base}/_offsets/{part}")
    elif ids == "hash":
        wide = add_hash_ids(cleaned, sources)
        path = f"{base}/_wide/{part}"
        files.write_table(wide.observe(seen_clean, F.count(F.lit(1)).alias("rows")), path, partition_by=[SOURCE_COL])
        wide = files.read_written(spark, path, schema=wide.schema)
    else:
        raise ValueError("ids must be 'sequence' or 'hash'")
    if distinct is not None:
        files.remove(spark, distinct)
    observed = {"raw_rows": seen_raw.get["rows"], "clean_rows": seen_clean.get["rows"]}
    log.info("rows before cleaning %(raw_rows)d, after %(clean_rows)d", observed)
    if counts is not None:
        counts.update(observed)
    tables = {"_wide": versions.Table([tag], wide.schema.json())}
    for name, df in star.star_tables(wide, host_grain=host_grain, fact_partitions=fact_partitions).items():
        # The fact is partitioned by source for pruning; it is not repartitioned by
        # source first, so a source holding a third of the rows is not one writer task.
        tables[name] = versions.write_part(df, base, name, tag, fmt, compression, [SOURCE_COL] if name == "booking" else None)
    if ids == "sequence":
        tables["_offsets"] = versions.Table([tag], "{}")
    versions.publish(spark, base, versions.Manifest(before.version + 1, tables))
    versions.expire(spark, base, keep_versions)
    out = versions.read_tables(spark, base)
    if register:
        files.register_views(spark, out)
    return out


def run_from_files(spark: SparkSession, registry: Mapping[str, str], sources: DataFrame,
                   out_dir: str, multi_line: bool | Mapping[str, bool] = True, **options) -> dict[str, DataFrame]:
    """Same, reading one CSV folder per source: ``{source name: path}``.

    ``multi_line=False``, for all sources or by name, lets Spark split large
    files whose values hold no line breaks.
    """
    return run(spark, files.read_sources(spark, registry, multi_line), sources, out_dir, **options)
