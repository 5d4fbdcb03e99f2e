"""The ETL in increments: each batch of raw rows adds to the star schema, and none is lost or taken twice.

What is kept between batches is small or only appended: digests of the rows
seen (a column of the wide rows), each source's last number, counts per
check-in value for the modes, and each host's state.  A batch reads no wide
row of an earlier one but its digest, and its plan does not grow with their
number.  Parts, state and the ledger of batches become visible together, in
one manifest (``sources.versions``).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MODE_COLUMNS, NATURAL_KEY, SOURCE_COL, TABLE_COLUMNS
from ..operators.impute import merged_counts, modes_of, value_counts
from ..operators.keys import add_hash_ids, ids_from_numbers, row_digest, tag_rows, with_numbers, write_offsets
from ..operators.schema import source_constants
from ..session import checked_broadcast, scratch_path, with_compiled
from ..sources import files, versions
from ..sources.versions import Manifest, Table
from . import star


def run_increment(spark: SparkSession, raw: DataFrame, sources: DataFrame, out_dir: str, batch: int | str,
                  unset: str = "null", host_grain: str = "host", enrichment: star.Enrichment | None = None,
                  ids: str = "sequence", fmt: str = "parquet", compression: str | None = None,
                  register: bool = False, keep_versions: int = 2) -> dict[str, DataFrame]:
    """One drop of raw rows added to the star schema; ids given earlier never change.

    Rows seen in an earlier batch are left out (by a digest of the row before
    enrichment); the others are numbered on from each source's last number.
    Batches may come in any order.  The ledger keeps a fingerprint of every
    batch's rows: the same batch again changes nothing and returns the tables
    as they are, so a retry neither loses nor repeats rows, however many
    batches came in between; other rows under a known batch raise.  A batch
    that dies half-way is in no version, and its retry starts anew.
    ``sources``, ``unset``, ``host_grain``, ``ids`` and ``fmt`` should stay the same.
    """
    if ids not in ("sequence", "hash"):
        raise ValueError("ids must be 'sequence' or 'hash'")
    base, name = out_dir.rstrip("/"), str(batch)
    before = versions.read_manifest(spark, base)
    if before.version and not before.batches:
        raise ValueError("the folder holds a full run; begin increments in a folder of their own")
    drop = _drop(spark, raw)
    row = drop.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("_digest").cast("decimal(20,0)")).alias("sum")).first()
    fingerprint = f"{row['n']}:{row['sum'] or 0}"
    known = before.batches.get(name)
    if known is None:
        after = _added(spark, drop, sources, base, name, before, _Options(unset, host_grain, enrichment, ids, fmt, compression))
        after.batches = {**before.batches, name: fingerprint}
        versions.publish(spark, base, after)
        versions.expire(spark, base, keep_versions)
    elif known != fingerprint:
        raise ValueError(f"batch {name} is known with other rows; give these a number of their own")
    out = versions.read_tables(spark, base)
    if register:
        files.register_views(spark, out)
    return out


class _Options:
    def __init__(self, unset: str, host_grain: str, enrichment: star.Enrichment | None, ids: str, fmt: str,
                 compression: str | None) -> None:
        self.unset, self.host_grain, self.enrichment, self.ids, self.fmt, self.compression = (
            unset, host_grain, enrichment, ids, fmt, compression)


def _drop(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """The drop's distinct rows with their digests, written once."""
    rows = star.distinct_listings(raw)
    rows = with_compiled(rows, "_digest", row_digest(rows, rows.columns), rows.columns[0])
    path = scratch_path(spark, "drop")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _added(spark: SparkSession, drop: DataFrame, sources: DataFrame, base: str, batch: str, before: Manifest,
           options: _Options) -> Manifest:
    """The manifest after the batch; its parts are written, the ledger is the caller's."""
    tag, tables = versions.new_tag(re.sub(r"\W+", "-", batch)), dict(before.tables)

    def read(name: str, columns: list[str] | None = None) -> list[DataFrame]:
        return [versions.read_table(spark, base, name, before.tables[name], columns)] if name in before.tables else []

    def put(df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None, whole: bool = False) -> None:
        """A new part, or the whole table anew."""
        part = versions.write_part(df, base, name, tag, fmt, options.compression if fmt == options.fmt else None, partition_by)
        tables[name] = part if whole else versions.added(before.tables.get(name), part)

    for seen in read("_wide", ["_digest"]):
        # A drop within the bound is broadcast to the digests of earlier rows, which then are not shuffled.
        again = seen.join(checked_broadcast(drop.select("_digest")), "_digest", "left_semi")
        drop = drop.join(again, "_digest", "left_anti")
    wide = _wide(spark, drop, sources, base, tag, options, read)
    tables["_wide"] = versions.added(before.tables.get("_wide"), Table([tag], wide.schema.json()))
    if options.ids == "sequence":
        numbers = [wide.groupBy(SOURCE_COL).agg(F.max("_seq").alias("_start")), *read("_numbers")]
        put(numbers[0] if len(numbers) == 1 else numbers[0].unionByName(numbers[1]).groupBy(SOURCE_COL).agg(F.max("_start").alias("_start")),
            "_numbers", whole=True)
        wide = ids_from_numbers(wide, sources, "_seq")
    new = star.star_tables(wide, host_grain=options.host_grain)
    for name in star.ROW_TABLES + (["host"] if options.host_grain == "listing" else []):
        put(new[name], name, options.fmt, [SOURCE_COL] if name == "booking" else None)
    if options.host_grain == "host":
        put(star.merged_hosts([star.host_state(wide.select(*TABLE_COLUMNS["host"])), *read("_hosts")]), "_hosts", whole=True)
        put(star.hosts_of(versions.read_table(spark, base, "_hosts", tables["_hosts"])), "host", options.fmt, whole=True)
    times = star.split_checkin(wide.select(*TABLE_COLUMNS["checkin"]))
    put(times, "_checkin")
    put(merged_counts([value_counts(times, MODE_COLUMNS), *read("_values")]), "_values", whole=True)
    found = modes_of(versions.read_table(spark, base, "_values", tables["_values"]), MODE_COLUMNS).first()
    modes = {c: found[c] if found else None for c in MODE_COLUMNS}
    # While the modes stay, new check-in rows are added; when one changes, all are filled anew from their texts.
    if "checkin" in before.tables and modes == before.facts:
        put(star.fill_checkin(times, modes), "checkin", options.fmt)
    else:
        put(star.fill_checkin(versions.read_table(spark, base, "_checkin", tables["_checkin"]), modes), "checkin", options.fmt, whole=True)
    return Manifest(before.version + 1, tables, facts=modes)


def _wide(spark: SparkSession, drop: DataFrame, sources: DataFrame, base: str, tag: str, options: _Options,
          read: Callable[[str], list[DataFrame]]) -> DataFrame:
    """The batch's wide rows, written: with ``_digest`` and their numbers ``_seq``, or with hash ids."""
    rows = drop
    if options.enrichment is not None:
        # New rows only, written so that lookups and joins read them and not the anti join again.
        path = scratch_path(spark, "new")
        rows.write.parquet(path)
        rows = star.enrich_listings(spark.read.schema(drop.schema).parquet(path), sources, options.enrichment)
    rows = source_constants(rows, sources, unset=options.unset)
    path = f"{base}/_wide/{versions.PART}={tag}"
    if options.ids == "hash":
        wide = add_hash_ids(rows, sources, carried=("_digest",))
        wide.write.parquet(path)
        return spark.read.schema(wide.schema).parquet(path)
    rest = [c for c in star.TARGETS if c not in (SOURCE_COL, NATURAL_KEY)]
    tagged = tag_rows(rows.select(*star.TARGETS, "_digest"), [SOURCE_COL], [NATURAL_KEY], scratch_path(spark, "tagged"), rest)
    start = next(iter(read("_numbers")), None)
    offsets = write_offsets(tagged, [SOURCE_COL], scratch_path(spark, "offsets"), start)
    wide = with_numbers(tagged, offsets, [SOURCE_COL], "_seq")
    wide.write.parquet(path)
    return spark.read.schema(wide.schema).parquet(path)
