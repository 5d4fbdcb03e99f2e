"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Listings come from the dirty view over ``orders``/``customer``/``nation``
(whole tables); text operators read ``documents`` and ``conversations``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..config import MODE_COLUMNS, SOURCE_COL, TABLE_COLUMNS, TARGET_COLUMNS, TARGET_TYPES
from ..functions.clock import clock_24h
from ..functions.flags import flag
from ..functions.json import postal_code
from ..functions.text import amenity_list, strip_quotes, strip_symbols
from ..operators import enrich
from ..operators.impute import mode_values
from ..operators.keys import add_monotonic_ids
from ..operators.quality import (dedupe_rows, drop_common_missing, plain_text_gate, row_profile,
                                 schema_report, strip_symbols_all)
from ..operators.schema import apply_mapping, ensure_columns, source_constants
from ..session import default_parallelism, read_table, scratch_path
from ..sources import files, versions
from ..streaming.incremental import ingest_new_files
from . import etl, star

Query = Callable[[SparkSession, str], DataFrame]

# Radius of the postcode lookup.
POSTCODE_RADIUS_KM = 1500.0

# Raw headers dropped from every source for the absent-column query.
DROPPED_HEADERS = ["Zipcode", "Bedrooms", "Amenities"]

# Orders a landing task takes: more than elsewhere, as it writes a file for every source.
LANDED_ROWS_PER_TASK = 300_000

# Columns that keep a listing identifiable in per-row outputs.
ROW_KEY = [SOURCE_COL, "propertyId"]


def _mapped(spark: SparkSession, sf: str) -> DataFrame:
    return star.mapped_listings(fx.raw_listings(spark, sf))


def _wide(spark: SparkSession, sf: str, ids: str = "sequence") -> DataFrame:
    return star.clean_listings(fx.raw_listings(spark, sf), fx.source_registry(spark, sf), ids=ids)


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return star.star_tables(_wide(spark, sf))


def _dirty_text(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.dirty_listings(spark, sf)
    return d.select(*[F.col(c).cast("string").alias(c) for c in d.columns])


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------

def q_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv_scan")
    files.write_raw(fx.dirty_listings(spark, sf), path)
    return files.read_csv_source(spark, path)


def _landed(spark: SparkSession, sf: str, name: str) -> tuple[str, list[str]]:
    path = scratch_path(spark, name)
    files.land_by_source(fx.raw_listings(spark, sf, LANDED_ROWS_PER_TASK), path)
    names = [r[0] for r in fx.source_registry(spark, sf).select(SOURCE_COL).collect()]
    return path, names


def q_landing_by_source(spark: SparkSession, sf: str) -> DataFrame:
    path, _ = _landed(spark, sf, "landing")
    return files.read_landed(spark, path, list(fx.RAW_HEADERS.values()))


def q_source_union(spark: SparkSession, sf: str) -> DataFrame:
    path, names = _landed(spark, sf, "union")
    return _source_summary(files.read_sources(spark, files.raw_zone_registry(spark, path, names)))


def _source_summary(united: DataFrame) -> DataFrame:
    return apply_mapping(united).groupBy(SOURCE_COL).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("zipcode").alias("zipcodes"),
        F.sum(F.col("annualRevenueLtmUSD").cast("decimal(14,2)")).cast("decimal(18,2)").alias("revenue"))


def _second_drop() -> Column:
    """Half of the raw rows, by two columns, so that a drop's rows are chosen before they are made wide."""
    return F.xxhash64(*[F.col(f"`{fx.RAW_HEADERS[c]}`") for c in ("property_id", "revenue")]) % 2 == 0


def q_source_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Every source in two drops, the columns of the second in the opposite order."""
    raw = fx.raw_listings(spark, sf, LANDED_ROWS_PER_TASK)
    path = scratch_path(spark, "source_headers")
    columns = [c for c in raw.columns if c != SOURCE_COL]
    second = _second_drop()
    files.land_by_source(raw.where(~second), path)
    files.land_by_source(raw.where(second).select(SOURCE_COL, *[f"`{c}`" for c in reversed(columns)]), path, mode="append")
    names = [r[0] for r in fx.source_registry(spark, sf).select(SOURCE_COL).collect()]
    return _source_summary(files.read_sources(spark, files.raw_zone_registry(spark, path, names)))


def q_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    dirty = fx.dirty_listings(spark, sf)
    path = scratch_path(spark, "sink")
    files.write_table(dirty, path, fmt="csv", compression="gzip")
    return files.read_written(spark, path, fmt="csv", schema=dirty.schema)


def q_incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two file drops, three runs: first drop, nothing new, second drop."""
    dirty = _dirty_text(spark, sf)
    base = scratch_path(spark, "incremental")
    inbox, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    first = F.col("src_no").cast("int") % 2 == 0
    files.write_raw(dirty.where(first), f"{inbox}/drop1")
    ingest_new_files(spark, f"{inbox}/*", dirty.columns, sink, ckpt)
    ingest_new_files(spark, f"{inbox}/*", dirty.columns, sink, ckpt)
    files.write_raw(dirty.where(~first), f"{inbox}/drop2")
    ingest_new_files(spark, f"{inbox}/*", dirty.columns, sink, ckpt)
    return spark.read.parquet(sink)


# ---------------------------------------------------------------------------
# Schema and constants
# ---------------------------------------------------------------------------

def q_column_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return apply_mapping(fx.raw_listings(spark, sf))


def q_ensure_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.raw_listings(spark, sf).drop(*DROPPED_HEADERS)
    return ensure_columns(apply_mapping(raw), TARGET_TYPES)


def _constants(spark: SparkSession, sf: str, unset: str) -> DataFrame:
    df = source_constants(_mapped(spark, sf), fx.source_registry(spark, sf), unset=unset)
    return df.select(*ROW_KEY, "country", "state", "city", "currencyNative")


def q_source_constants(spark: SparkSession, sf: str) -> DataFrame:
    return _constants(spark, sf, "null")


def q_source_constants_keep(spark: SparkSession, sf: str) -> DataFrame:
    return _constants(spark, sf, "keep")


def q_row_profile(spark: SparkSession, sf: str) -> DataFrame:
    return row_profile(apply_mapping(fx.raw_listings(spark, sf)), TARGET_COLUMNS)


# ---------------------------------------------------------------------------
# Filters, duplicates, text
# ---------------------------------------------------------------------------

def q_drop_common_missing(spark: SparkSession, sf: str) -> DataFrame:
    return drop_common_missing(_mapped(spark, sf)).select(
        *ROW_KEY, "propertyType", "listingType", "bedrooms")


def q_dedupe_rows(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_rows(drop_common_missing(_mapped(spark, sf)))


def q_strip_symbols(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf).select(*ROW_KEY, strip_symbols("listingTitle").alias("listingTitle"))


def q_strip_symbols_all(spark: SparkSession, sf: str) -> DataFrame:
    return strip_symbols_all(_mapped(spark, sf))


def q_strip_quotes(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf).select(*ROW_KEY, strip_quotes("listingTitle").alias("listingTitle"))


def q_plain_text_gate(spark: SparkSession, sf: str) -> DataFrame:
    docs = plain_text_gate(read_table(spark, sf, "documents", spread_rows=True), ["text", "lang", "source"])
    conv = plain_text_gate(read_table(spark, sf, "conversations", spread_rows=True), ["role", "text"])
    return docs.select(F.lit("documents").alias("tbl"), "*").unionByName(
        conv.select(F.lit("conversations").alias("tbl"), "*"))


# ---------------------------------------------------------------------------
# Flags, check-in text, clock, amenities
# ---------------------------------------------------------------------------

def q_flags_to_bool(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["instantBookable", "petsAllowed", "exactLocation", "instantBookEnabled"]
    return _mapped(spark, sf).select(*ROW_KEY, *[flag(c).alias(c) for c in cols])


def q_flags_host(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf).select(*ROW_KEY, "hostId", flag("superhost").alias("superhost"))


def q_checkin_split(spark: SparkSession, sf: str) -> DataFrame:
    return star.split_checkin(_mapped(spark, sf).select(*ROW_KEY, "checkinTime"))


def q_clock_24h(spark: SparkSession, sf: str) -> DataFrame:
    df = star.split_checkin(_mapped(spark, sf).select(*ROW_KEY, "checkinTime", "checkoutTime"))
    return df.select(*ROW_KEY, *[clock_24h(c).alias(c) for c in MODE_COLUMNS])


def q_amenities_array(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf).select(*ROW_KEY, amenity_list("amenities").alias("amenities"))


def q_amenities_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return star.amenities_bridge(_tables(spark, sf)["amenities"])


# ---------------------------------------------------------------------------
# Modes and fills
# ---------------------------------------------------------------------------

def _checkin_text(spark: SparkSession, sf: str) -> DataFrame:
    return star.split_checkin(_mapped(spark, sf).select(*ROW_KEY, *TABLE_COLUMNS["checkin"][1:]))


def q_mode_values(spark: SparkSession, sf: str) -> DataFrame:
    return mode_values(_checkin_text(spark, sf), MODE_COLUMNS)


def q_mode_impute(spark: SparkSession, sf: str) -> DataFrame:
    return star.fill_checkin(_checkin_text(spark, sf))


def _fill_query(table: str, fill: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        cols = [c for c in TABLE_COLUMNS[table] if not c.endswith("Id") or c in ("propertyId", "hostId")]
        keep = [c for c in ROW_KEY if c not in cols]
        return fill(_mapped(spark, sf).select(*keep, *cols))
    return run


# ---------------------------------------------------------------------------
# Keys, star tables, star queries
# ---------------------------------------------------------------------------

def _id_query(ids: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        wide = _wide(spark, sf, ids=ids)
        return wide.select(*ROW_KEY, *[c for c in wide.columns if c.endswith("Id") and c not in
                                        ("propertyId", "hostId")])
    return run


def _table_query(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _tables(spark, sf)[name]
    return run


def q_star_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return star.orphans(_tables(spark, sf))


def q_star_revenue_by_city(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf)
    return star.revenue_by_city(t["booking"], t["location"], t["host"])


def q_star_revenue_laid_out(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the tables of a run, laid out in buckets by their join keys."""
    out = scratch_path(spark, "laid_out")
    etl.run(spark, fx.raw_listings(spark, sf), fx.source_registry(spark, sf), out, register=False)
    t = versions.lay_out_tables(spark, out, "martline_layout", default_parallelism(spark))
    return star.revenue_by_city(t["booking"], t["location"], t["host"])


def q_star_host_summary(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf)
    return star.host_summary_sql(t["booking"], t["host"])


# ---------------------------------------------------------------------------
# Enrichment
# ---------------------------------------------------------------------------

def q_detect_language(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.detect_language(fx.texts(spark, sf), "text").drop("text")


def q_translate_memo(spark: SparkSession, sf: str) -> DataFrame:
    conv = fx.talk(spark, sf).select("conv_id", "turn", "text")
    memo = fx.translation_memo(spark, sf)
    out = enrich.translate_memo(conv, "text", memo, out="text_en")
    return out.select("conv_id", "turn", "text_en")


def q_translate_unseen(spark: SparkSession, sf: str) -> DataFrame:
    conv = fx.talk(spark, sf)
    return enrich.translate_unseen(conv, "text", fx.translation_memo(spark, sf))


def q_translate_gated(spark: SparkSession, sf: str) -> DataFrame:
    conv = fx.talk(spark, sf)
    return enrich.translate_gated(conv, fx.translation_memo(spark, sf), ["role", "text"])


def q_nearest_postcode(spark: SparkSession, sf: str) -> DataFrame:
    listings = _mapped(spark, sf).select(*ROW_KEY, "latitude", "longitude")
    return enrich.nearest_postcode(listings, fx.postcode_points(spark, sf), POSTCODE_RADIUS_KM)


def q_geocode_payload(spark: SparkSession, sf: str) -> DataFrame:
    payloads = fx.geocoder_payloads(spark, sf)
    return payloads.select("property_id", postal_code("payload").alias("postcode"))


def _lower(s):  # the injected "service": any Series -> Series function
    return s.str.lower()


def q_enrich_hook(spark: SparkSession, sf: str) -> DataFrame:
    conv = read_table(spark, sf, "conversations", spread_rows=True)
    return enrich.enrich_hook(conv, "text", _lower, max_calls_per_second=1_000_000)


# ---------------------------------------------------------------------------
# Whole runs
# ---------------------------------------------------------------------------

def q_etl_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Listings after a run with enrichment: titles translated, missing postcodes filled, per source."""
    enrichment = star.Enrichment(fx.title_memo(spark, sf), fx.postcode_points(spark, sf), POSTCODE_RADIUS_KM)
    tables = etl.run(spark, fx.raw_listings(spark, sf), fx.source_registry(spark, sf), scratch_path(spark, "enriched"),
                     enrichment=enrichment, register=False)
    listing = tables["listing"].select("listingId", "propertyId", "listingTitle")
    # Both dimensions are 1:1 with the fact, through their own ids.
    return (tables["booking"].select(SOURCE_COL, "listingId", "locationId").join(listing, "listingId")
            .join(tables["location"].select("locationId", "zipcode", "latitude", "longitude"), "locationId")
            .select(SOURCE_COL, "propertyId", "listingTitle", "zipcode", "latitude", "longitude"))


# Rows of the first drop; the second one delivers all rows, those of the first again.
FIRST_DROP = "`Number of Bookings LTM - Number of observed month` IN ('0', '2', '4', '6', '8', '10')"


def q_incremental_etl(spark: SparkSession, sf: str) -> DataFrame:
    raw, sources, out = fx.raw_listings(spark, sf), fx.source_registry(spark, sf), scratch_path(spark, "increments")
    etl.run_increment(spark, raw.where(FIRST_DROP), sources, out, 0)
    tables = etl.run_increment(spark, raw, sources, out, 1)
    return tables["booking"].select(SOURCE_COL, "propertyId", "listingId", "bookingId")


def q_etl_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts: dict[str, int] = {}
    etl.run(spark, fx.raw_listings(spark, sf), fx.source_registry(spark, sf), scratch_path(spark, "counted"),
            register=False, counts=counts)
    return spark.createDataFrame([(k, v) for k, v in counts.items()], "step string, rows long")


def q_catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The tables of a run, attached to the catalog and counted there by SQL."""
    out = scratch_path(spark, "catalog")
    etl.run(spark, fx.raw_listings(spark, sf), fx.source_registry(spark, sf), out, register=False)
    names = versions.attach_tables(spark, out, "martline_star")
    return spark.sql(" UNION ALL ".join(f"SELECT '{n.split('.')[1]}' AS table_name, count(*) AS rows FROM {n}" for n in names))


def q_schema_report(spark: SparkSession, sf: str) -> DataFrame:
    return schema_report(fx.raw_listings(spark, sf))


def q_unparsed_times(spark: SparkSession, sf: str) -> DataFrame:
    return star.unparsed_times(star.split_checkin(_mapped(spark, sf).select(*ROW_KEY, "checkinTime", "checkoutTime")))


def q_monotonic_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Per source: rows, distinct ids, and ids that carry the source's prefix."""
    sources = fx.source_registry(spark, sf)
    df = add_monotonic_ids(_mapped(spark, sf).select(SOURCE_COL, "propertyId"), sources)
    known = df.join(F.broadcast(sources.select(SOURCE_COL, "prefix")), SOURCE_COL)
    return known.groupBy(SOURCE_COL).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("listingId").alias("ids"),
        F.count_if(F.col("listingId").rlike("^C[0-9]{2}LIS[0-9]+$") & F.col("listingId").startswith(F.col("prefix"))).alias("prefixed"))


FACT_PARTITIONS = 7


def q_fact_repartition(spark: SparkSession, sf: str) -> DataFrame:
    fact = star.star_tables(_wide(spark, sf), fact_partitions=FACT_PARTITIONS)["booking"]
    return fact.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("rows"))


QUERIES: dict[str, Query] = {
    "csv_scan": q_csv_scan,
    "source_union": q_source_union,
    "source_headers": q_source_headers,
    "landing_by_source": q_landing_by_source,
    "sink_roundtrip": q_sink_roundtrip,
    "incremental_ingest": q_incremental_ingest,
    "column_mapping": q_column_mapping,
    "ensure_columns": q_ensure_columns,
    "source_constants": q_source_constants,
    "source_constants_keep": q_source_constants_keep,
    "drop_common_missing": q_drop_common_missing,
    "dedupe_rows": q_dedupe_rows,
    "strip_symbols": q_strip_symbols,
    "strip_symbols_all": q_strip_symbols_all,
    "strip_quotes": q_strip_quotes,
    "flags_to_bool": q_flags_to_bool,
    "flags_host": q_flags_host,
    "checkin_split": q_checkin_split,
    "clock_24h": q_clock_24h,
    "amenities_array": q_amenities_array,
    "amenities_bridge": q_amenities_bridge,
    "mode_values": q_mode_values,
    "mode_impute": q_mode_impute,
    "fill_listing": _fill_query("listing", star.fill_listing),
    "fill_location": _fill_query("location", star.fill_location),
    "fill_host": _fill_query("host", star.fill_host),
    "fill_review": _fill_query("review", star.fill_review),
    "fill_pricing": _fill_query("pricing", star.fill_pricing),
    "fill_fact": _fill_query("booking", star.fill_fact),
    "surrogate_ids": _id_query("sequence"),
    "hash_ids": _id_query("hash"),
    "dim_listing": _table_query("listing"),
    "dim_host": _table_query("host"),
    "dim_location": _table_query("location"),
    "dim_amenities": _table_query("amenities"),
    "dim_review": _table_query("review"),
    "dim_checkin": _table_query("checkin"),
    "dim_pricing": _table_query("pricing"),
    "fact_booking": _table_query("booking"),
    "star_orphans": q_star_orphans,
    "star_revenue_by_city": q_star_revenue_by_city,
    "star_revenue_laid_out": q_star_revenue_laid_out,
    "star_host_summary": q_star_host_summary,
    "row_profile": q_row_profile,
    "plain_text_gate": q_plain_text_gate,
    "detect_language": q_detect_language,
    "translate_memo": q_translate_memo,
    "translate_unseen": q_translate_unseen,
    "translate_gated": q_translate_gated,
    "nearest_postcode": q_nearest_postcode,
    "geocode_payload": q_geocode_payload,
    "enrich_hook": q_enrich_hook,
    "etl_enriched": q_etl_enriched,
    "incremental_etl": q_incremental_etl,
    "etl_counts": q_etl_counts,
    "catalog_tables": q_catalog_tables,
    "schema_report": q_schema_report,
    "unparsed_times": q_unparsed_times,
    "monotonic_ids": q_monotonic_ids,
    "fact_repartition": q_fact_repartition,
}
