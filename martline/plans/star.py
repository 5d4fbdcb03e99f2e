"""The cleaned wide listing frame, its split into a star schema, and star queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (FILL_DEFAULTS, FLAG_COLUMNS, MODE_COLUMNS, SOURCE_COL, TABLE_COLUMNS,
                      TARGET_TYPES)
from ..functions.clock import checkin_window, clock_24h
from ..functions.flags import flag
from ..functions.text import amenity_list, strip_quotes
from ..operators.enrich import learn_postcodes, learn_translations, memo_postcode, nearest_postcode, translate_memo
from ..operators.impute import fill_defaults, mode_impute
from ..operators.keys import add_hash_ids, add_surrogate_ids
from ..operators.quality import dedupe_rows, drop_common_missing, strip_symbols_all
from ..operators.schema import apply_mapping, ensure_columns, source_constants, source_count
from ..session import checked_broadcast, scratch_path, shuffles_removed, tasks_for

# Columns of the cleaned wide rows before ids are given.
TARGETS = [SOURCE_COL, *TARGET_TYPES]

DIMENSIONS = ["listing", "host", "location", "amenities", "review", "checkin", "pricing"]


def mapped_listings(raw: DataFrame) -> DataFrame:
    """Raw text under file headers -> typed target columns, absent ones as NULL."""
    return ensure_columns(apply_mapping(raw), TARGET_TYPES)


@dataclass(frozen=True)
class Enrichment:
    """What enriches the listings of the sources that ask for it.

    The source table's flags ``translate`` and ``geocode`` name the sources.
    ``memo`` holds translations, ``points`` postcode points.  With a hook, a
    service is asked for what they do not know, each text and each coordinate
    cell once: ``translate`` and ``geocode`` answer a batch of texts or cells
    (``lat,lon``; JSON answers), and their answers are kept in the folders ``texts_path``
    and ``cells_path``, from which later runs take them.
    """

    memo: DataFrame | None = None
    points: DataFrame | None = None
    radius_km: float = 50.0
    text_columns: tuple[str, ...] = ("listingTitle",)
    translate: Callable[[pd.Series], pd.Series] | None = None
    texts_path: str | None = None
    geocode: Callable[[pd.Series], pd.Series] | None = None
    cells_path: str | None = None
    calls_per_second: float | None = None


def enrich_listings(df: DataFrame, sources: DataFrame, enrichment: Enrichment) -> DataFrame:
    """Texts translated through the memo, and missing postcodes taken from the nearest point, per source.

    Rows of sources without a flag pass through the same joins under keys that
    meet nothing, or pass by where a join would shuffle them; a postcode that a listing has is
    kept.  The coordinates to look up are read before the rows: pass a written
    frame where ``df`` is costly.
    """
    return located_listings(translated_listings(df, sources, enrichment), sources, enrichment)


def _flagged(df: DataFrame, sources: DataFrame) -> DataFrame:
    """``df`` with the flags ``_translate`` and ``_geocode`` of each row's source, never NULL for a known source."""
    flags = sources.select(F.col(SOURCE_COL).alias("_f_src"), F.coalesce("translate", F.lit(False)).alias("_translate"),
                           F.coalesce("geocode", F.lit(False)).alias("_geocode"))
    n = source_count(flags, "_f_src")
    return df.join(checked_broadcast(flags, known_rows=n), F.col(SOURCE_COL) == F.col("_f_src"), "left")


def translated_listings(df: DataFrame, sources: DataFrame, enrichment: Enrichment) -> DataFrame:
    """The first half of ``enrich_listings``; ``df`` is read twice only where a service is asked."""
    memos, columns, flagged = [m for m in [enrichment.memo] if m is not None], df.columns, F.coalesce("_translate", F.lit(False))
    if not memos and enrichment.translate is None:
        return df
    df = _flagged(df, sources)
    if enrichment.translate is not None:
        memos.append(_answers(df.where(flagged), enrichment, memos))
    for c in enrichment.text_columns:
        df = translate_memo(df, c, reduce(DataFrame.unionByName, memos), only=flagged)
    return df.select(*columns)


def located_listings(df: DataFrame, sources: DataFrame, enrichment: Enrichment) -> DataFrame:
    """The second half of ``enrich_listings``."""
    if enrichment.points is None and enrichment.geocode is None:
        return df
    columns, df = df.columns, _flagged(df, sources)
    if enrichment.points is not None:
        wanted = F.coalesce("_geocode", F.lit(False)) & F.col("zipcode").isNull()
        df = nearest_postcode(df, enrichment.points, enrichment.radius_km, out="_postcode", only=wanted)
        df = df.withColumn("zipcode", F.coalesce("zipcode", "_postcode")).drop("_postcode")
    if enrichment.geocode is not None:
        wanted = F.coalesce("_geocode", F.lit(False)) & F.col("zipcode").isNull()
        known = learn_postcodes(df.where(wanted), enrichment.cells_path, enrichment.geocode, max_calls_per_second=enrichment.calls_per_second)
        df = memo_postcode(df, known, wanted, "_postcode").withColumn("zipcode", F.coalesce("zipcode", "_postcode"))
    return df.select(*columns)


def _answers(df: DataFrame, enrichment: Enrichment, memos: list[DataFrame]) -> DataFrame:
    """The service's translations after a round for texts that no memo holds."""
    texts = reduce(DataFrame.unionByName, [df.select(F.col(c).alias("text")) for c in enrichment.text_columns])
    for memo in memos:
        texts = texts.join(memo.select(F.col("source_text").alias("text")).distinct(), "text", "left_anti")
    return learn_translations(texts, "text", enrichment.texts_path, enrichment.translate, enrichment.calls_per_second)


def distinct_listings(raw: DataFrame) -> DataFrame:
    """map and cast -> absent columns -> drop empty rows -> drop exact copies -> strip symbols from text."""
    return strip_symbols_all(dedupe_rows(drop_common_missing(mapped_listings(raw))))


def cleaned_rows(raw: DataFrame, sources: DataFrame, unset: str = "null", enrichment: Enrichment | None = None,
                 distinct_path: str | None = None) -> DataFrame:
    """``distinct_listings`` -> enrichment -> source constants.

    For enrichment the rows are written once (to ``distinct_path``, or scratch),
    so that its lookups and its joins read them and not the raw rows again.
    Titles are translated on the way there, unless a service has to see them
    first: what follows is read more than once, and languages cost the most.
    """
    df = distinct_listings(raw)
    if enrichment is not None:
        early = enrichment.translate is None
        if early:
            df = translated_listings(df, sources, enrichment)
        path = distinct_path or scratch_path(df.sparkSession, "distinct")
        with shuffles_removed(df.sparkSession):
            df.write.parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
        df = (located_listings if early else enrich_listings)(df, sources, enrichment)
    return source_constants(df, sources, unset=unset)


def clean_listings(raw: DataFrame, sources: DataFrame, unset: str = "null", ids: str = "sequence",
                   enrichment: Enrichment | None = None, wide_path: str | None = None) -> DataFrame:
    """The wide frame every table is cut from: ``cleaned_rows`` with surrogate ids.

    ``ids="sequence"`` numbers listings 1, 2, ... per source (deterministic);
    ``ids="hash"`` derives them from the row with no shuffle.  With
    ``wide_path`` the copy written for the sequence is kept there.
    """
    df = cleaned_rows(raw, sources, unset, enrichment)
    if ids == "sequence":
        return add_surrogate_ids(df, sources, path=wide_path)
    if ids == "hash":
        return add_hash_ids(df, sources)
    raise ValueError("ids must be 'sequence' or 'hash'")


def _flags(df: DataFrame, table: str) -> DataFrame:
    names = set(FLAG_COLUMNS.get(table, []))
    return df.select(*[flag(c).alias(c) if c in names else F.col(c) for c in df.columns])


def _fill(df: DataFrame, table: str) -> DataFrame:
    """Constant defaults, flags converted to booleans (NULL flag -> false)."""
    flags = set(FLAG_COLUMNS.get(table, []))
    defaults = {c: v for c, v in FILL_DEFAULTS[table].items() if c not in flags}
    return _flags(fill_defaults(df, defaults), table)


def fill_listing(df: DataFrame, quotes: str = "'") -> DataFrame:
    """Defaults, then quotes stripped from the title (a title of quotes becomes '')."""
    filled = _fill(df, "listing")
    return filled.withColumn("listingTitle", strip_quotes("listingTitle", quotes))


def fill_location(df: DataFrame) -> DataFrame:
    return _fill(df, "location")


def fill_review(df: DataFrame) -> DataFrame:
    return _fill(df, "review")


def fill_pricing(df: DataFrame) -> DataFrame:
    return _fill(df, "pricing")


def fill_host(df: DataFrame) -> DataFrame:
    return _fill(df, "host")


def fill_fact(df: DataFrame) -> DataFrame:
    """Defaults and the boolean flag; ``revenueKnown`` keeps the fact that
    revenue was present before its 0.0 default, for honest averages."""
    known = F.col("annualRevenueLtmUSD").isNotNull().alias("revenueKnown")
    # The host key takes the host dimension's default so unknown hosts still join.
    host_default = FILL_DEFAULTS["host"]["hostId"]
    df = fill_defaults(df.select("*", known), {"hostId": host_default})
    return _fill(df, "booking")


def split_checkin(df: DataFrame) -> DataFrame:
    """checkinTime -> checkinStartTime, checkinEndTime (text, trimmed)."""
    start, end = checkin_window("checkinTime")
    rest = [c for c in df.columns if c != "checkinTime"]
    return df.select(*rest, start.alias("checkinStartTime"), end.alias("checkinEndTime"))


def fill_checkin(df: DataFrame, modes: dict[str, str | None] | None = None) -> DataFrame:
    """Modes for the three time texts, then 24-hour ``HH:mm``; minimum stay 1.

    The fill happens before parsing, so text that is not a 12-hour time
    stays NULL after it.  ``modes`` gives modes that are known already.
    """
    filled = mode_impute(df, MODE_COLUMNS) if modes is None else fill_defaults(
        df, {c: m for c, m in modes.items() if m is not None})
    filled = fill_defaults(filled, FILL_DEFAULTS["checkin"])
    return filled.select(*[clock_24h(c).alias(c) if c in MODE_COLUMNS else F.col(c)
                           for c in filled.columns])


def unparsed_times(df: DataFrame) -> DataFrame:
    """Per check-in column: how many texts are not a 12-hour time and stay without a clock time."""
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & clock_24h(c).isNull()).alias(c) for c in MODE_COLUMNS])
    pairs = ", ".join(f"'{c}', `{c}`" for c in MODE_COLUMNS)
    return counts.select(F.expr(f"stack({len(MODE_COLUMNS)}, {pairs}) AS (column_name, unparsed)"))


def host_dimension(df: DataFrame, grain: str = "host") -> DataFrame:
    """One row per host (``grain="host"``): largest listing count, superhost if
    any listing says so.  ``grain="listing"`` keeps one row per listing.

    Hosts are grouped by the filled key, so that hosts without an id and those
    whose id is the default share one row; partial aggregation leaves that key
    one row a task to shuffle.
    """
    if grain == "listing":
        return fill_host(df.select(*TABLE_COLUMNS["host"]))
    if grain != "host":
        raise ValueError("grain must be 'host' or 'listing'")
    return hosts_of(host_state(df))


def host_state(df: DataFrame) -> DataFrame:
    """``hostId, hostListingCount, any_t`` per host: what the host dimension needs, mergeable (``merged_hosts``)."""
    key = {"hostId": FILL_DEFAULTS["host"]["hostId"]}
    return fill_defaults(df, key).groupBy("hostId").agg(
        F.max("hostListingCount").alias("hostListingCount"),
        F.coalesce(F.max(F.col("superhost") == F.lit("t")), F.lit(False)).alias("any_t"))


def merged_hosts(parts: list[DataFrame]) -> DataFrame:
    """The states of all parts together."""
    return reduce(DataFrame.unionByName, parts).groupBy("hostId").agg(
        F.max("hostListingCount").alias("hostListingCount"), F.max("any_t").alias("any_t"))


def hosts_of(state: DataFrame) -> DataFrame:
    """The host dimension of a state."""
    defaults = {c: v for c, v in FILL_DEFAULTS["host"].items() if c != "superhost"}
    return fill_defaults(state, defaults).select("hostId", "hostListingCount", F.col("any_t").alias("superhost"))


def amenities_array(df: DataFrame) -> DataFrame:
    return df.select("amenitiesId", amenity_list("amenities").alias("amenities"))


def amenities_bridge(df: DataFrame) -> DataFrame:
    """(amenitiesId, amenity), one row per item: a narrow bridge table instead of
    exploding the wide row."""
    return df.select("amenitiesId", F.explode(amenity_list("amenities")).alias("amenity"))


def star_tables(wide: DataFrame, host_grain: str = "host",
                fact_partitions: int | None = None) -> dict[str, DataFrame]:
    """Seven dimensions and the fact, cut from the cleaned wide frame.

    The fact also carries the ``src`` lineage column.  ``fact_partitions``
    repartitions the fact round-robin before writing (None: leave it to AQE).
    """
    t = TABLE_COLUMNS
    tables = {
        "listing": fill_listing(wide.select(*t["listing"])),
        "host": host_dimension(wide.select(*t["host"]), host_grain),
        "location": fill_location(wide.select(*t["location"])),
        "amenities": wide.select(*t["amenities"]),
        "review": fill_review(wide.select(*t["review"])),
        "checkin": fill_checkin(split_checkin(wide.select(*t["checkin"]))),
        "pricing": fill_pricing(wide.select(*t["pricing"])),
    }
    fact = fill_fact(wide.select(*t["booking"], SOURCE_COL))
    if fact_partitions:
        fact = fact.repartition(fact_partitions)
    tables["booking"] = fact
    return tables


#: Tables whose rows depend on one listing only, so that new listings add rows and change none.
ROW_TABLES = ["listing", "location", "amenities", "review", "pricing", "booking"]


# ---------------------------------------------------------------------------
# Queries over the star tables.
# ---------------------------------------------------------------------------

def _cents(c: str) -> F.Column:
    return (F.col(c).cast("decimal(14,2)") * F.lit(100)).cast("long")


def _avg_money(sum_cents: str, n: str) -> F.Column:
    """sum/n in cents, rounded half away from zero, as decimal(18,2).

    Integer arithmetic throughout, so the result is exact at any row count.
    """
    q = F.expr(f"CASE WHEN {sum_cents} >= 0 THEN ({sum_cents} * 2 + {n}) div ({n} * 2) "
               f"ELSE -((-{sum_cents} * 2 + {n}) div ({n} * 2)) END")
    return (q.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(18,2)")


def located_fact(fact: DataFrame, location: DataFrame) -> DataFrame:
    """The fact's revenue columns with country and city (1:1 on ``locationId``).

    Without a shuffle where both are laid out by that key (``versions.lay_out_tables``).
    """
    return fact.select(SOURCE_COL, "hostId", "locationId", "annualRevenueLtmUSD", "revenueKnown").join(
        location.select("locationId", "country", "city"), "locationId", "inner")


def revenue_by_city(fact: DataFrame, location: DataFrame, host: DataFrame) -> DataFrame:
    """Listings, hosts, total and average revenue per source, city and superhost.

    fact -> location (1:1 on locationId) and fact -> host (n:1 on hostId, host
    dimension one row per host).  Listings are added up per source, city and
    host before they meet the host dimension, so neither the fact nor a host with a
    third of its rows crosses that shuffle.  Totals are decimal sums of all
    listings; averages use only listings whose revenue was known.
    """
    known = F.col("revenueKnown")
    per_host = located_fact(fact, location).groupBy(SOURCE_COL, "country", "city", "hostId").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("annualRevenueLtmUSD").cast("decimal(14,2)")).alias("_revenue"),
        F.sum(F.when(known, _cents("annualRevenueLtmUSD"))).alias("_cents"),
        F.count_if(known).alias("_known"))
    agg = per_host.join(host.select("hostId", "superhost"), "hostId", "left").groupBy(SOURCE_COL, "country", "city", "superhost").agg(
        F.sum("_n").alias("listings"),
        F.count("hostId").alias("hosts"),
        F.sum("_revenue").cast("decimal(18,2)").alias("total_revenue"),
        F.sum("_cents").alias("_cents"),
        F.sum("_known").alias("_known"))
    avg = F.when(F.col("_known") > 0, _avg_money("_cents", "_known"))
    return agg.select(SOURCE_COL, "country", "city", "superhost", "listings", "hosts",
                      "total_revenue", avg.alias("avg_revenue"))


HOST_SUMMARY_SQL = """
SELECT h.hostId, h.superhost, h.hostListingCount, f.listings, f.sources, f.total_revenue
FROM {host} h
JOIN (SELECT hostId, count(*) AS listings, count(DISTINCT src) AS sources,
             CAST(SUM(CAST(annualRevenueLtmUSD AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS total_revenue
      FROM {booking} GROUP BY hostId) f
  ON h.hostId = f.hostId
"""


def host_summary_sql(fact: DataFrame, host: DataFrame) -> DataFrame:
    """Per host: superhost, declared listing count, listings in the fact, sources, revenue.

    Plain SQL over the star tables, as a dashboard would write it; the fact
    is aggregated per host (partial aggregation map-side) before the join.
    """
    return fact.sparkSession.sql(HOST_SUMMARY_SQL, booking=fact, host=host)


FACT_KEYS = {"listing": "listingId", "host": "hostId", "location": "locationId",
             "amenities": "amenitiesId", "review": "reviewId", "checkin": "checkInOutId",
             "pricing": "pricingId"}

#: Dimensions whose key many fact rows may share.
SHARED_KEYS = {"host"}


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose key has no row in the dimension, per dimension (expected 0).

    All seven checks share one anti join, by grouping: fact keys (with their
    number of rows) and dimension keys are united as (dimension, key) pairs, and
    a pair that no dimension brought is missing.  Pairs are dealt out over tasks by the number of
    fact rows (counted first: pass tables read from files), so that the keys a
    task holds do not grow with the input.  A NULL fact key counts as an orphan.
    """
    fact = tables["booking"]
    parts = []
    for d, k in FACT_KEYS.items():
        # A hot key (unknown host "0") collapses map-side before it is dealt out.
        rows = fact.groupBy(k).agg(F.count(F.lit(1)).alias("n")) if d in SHARED_KEYS else fact.select(k, F.lit(1).cast("long").alias("n"))
        parts.append(rows.select(F.lit(d).alias("dimension"), F.col(k).alias("key"), "n"))
        known = tables[d].where(F.col(k).isNotNull())
        parts.append(known.select(F.lit(d).alias("dimension"), F.col(k).alias("key"), F.lit(None).cast("long").alias("n")))
    pairs = reduce(DataFrame.unionByName, parts).repartition(tasks_for(fact), "dimension", "key")
    per_key = pairs.groupBy("dimension", "key").agg(F.sum("n").alias("n"), F.count_if(F.col("n").isNull()).alias("_known"))
    missing = per_key.where(F.col("_known") == 0)
    counted = missing.groupBy().pivot("dimension", list(FACT_KEYS)).agg(F.sum("n"))
    pairs = ", ".join(f"'{d}', coalesce(`{d}`, 0L)" for d in FACT_KEYS)
    return counted.select(F.expr(f"stack({len(FACT_KEYS)}, {pairs}) AS (dimension, orphans)"))
