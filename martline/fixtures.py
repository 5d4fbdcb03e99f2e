"""Test inputs derived from the driver tables.

The driver tables are clean, so listings are planted with dirt (all 53 raw
columns, each with and without values; NULL, repeated and zero keys; NULL
coordinates; numbers with suffixes) by one SQL
text that runs unchanged in Spark and DuckDB (``FIXTURES.md`` section 3).
Every table here grows with the driver tables; nothing is made up on the
driver.  Placeholders ``{orders}`` etc. become DataFrames in Spark
(``spark.sql(text, orders=df)``) and view names in DuckDB.

Differences from the text in ``FIXTURES.md``: every nation is a source (not
only the first nine), and the planted copies are not a cross join with a
two-row table: DuckDB reads a ``UNION ALL`` of the orders, Spark one scan
with an ``explode`` (``{orders_copies}``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import read_table, split_compiled, tasks_for

DIRTY_LISTINGS_SQL = """
SELECT n.n_nationkey AS src_no, 'city' || LPAD(CAST(n.n_nationkey AS STRING), 2, '0') AS src,
  CASE WHEN o.o_orderkey % 29 = 0 THEN NULL WHEN o.o_orderkey % 31 = 0 THEN 'P' || CAST(o.o_orderkey % 5 AS STRING)
       ELSE CAST(o.o_orderkey AS STRING) END AS property_id,
  CASE WHEN o.o_orderkey % 37 = 0 THEN NULL WHEN o.o_orderkey % 41 = 0 THEN '0' ELSE CAST(c.c_custkey AS STRING) END AS host_id,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
       WHEN o.o_orderkey % 53 = 0 THEN chr(39) || chr(39)
       WHEN o.o_orderkey % 14 = 1 THEN 'Belle maison ' || CAST(o.o_orderkey % 50 AS STRING)
       WHEN o.o_orderkey % 14 = 3 THEN '東京の家 ' || CAST(o.o_orderkey % 50 AS STRING)
       WHEN o.o_orderkey % 5 = 0 THEN 'Cosy \U0001F3E0 flat ★ ' || CAST(o.o_orderkey AS STRING)
       WHEN o.o_orderkey % 3 = 0 THEN chr(39) || 'Sea' || chr(39) || ' view ☀✨ ' || CAST(o.o_orderkey AS STRING)
       ELSE 'Plain room ' || CAST(o.o_orderkey AS STRING) END AS title,
  CASE WHEN o.o_orderkey % 13 = 0 OR o.o_orderkey % 23 = 0 THEN NULL WHEN o.o_orderkey % 4 = 0 THEN 'Apartment'
       WHEN o.o_orderkey % 4 = 1 THEN 'House' ELSE 'Villa' END AS property_type,
  CASE WHEN o.o_orderkey % 13 = 0 OR o.o_orderkey % 17 = 0 THEN NULL ELSE o.o_orderpriority END AS listing_type,
  CASE WHEN o.o_orderkey % 13 = 0 OR o.o_orderkey % 9 = 0 THEN NULL ELSE CAST(o.o_orderkey % 6 AS STRING) END AS bedrooms,
  CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 59 = 0 THEN '2d' WHEN o.o_orderkey % 2 = 0 THEN CAST(o.o_orderkey % 4 AS STRING) || '.5'
       ELSE CAST(o.o_orderkey % 4 AS STRING) END AS bathrooms,
  CASE WHEN o.o_orderkey % 19 = 0 THEN 'n/a' ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END AS created,
  CASE o.o_orderkey % 3 WHEN 0 THEN 't' WHEN 1 THEN 'f' ELSE NULL END AS superhost,
  CASE o.o_orderkey % 4 WHEN 0 THEN 't' WHEN 1 THEN 'f' WHEN 2 THEN 'x' ELSE NULL END AS instant_bookable,
  CASE o.o_orderkey % 8 WHEN 0 THEN 'After 3:00 PM' WHEN 1 THEN '3:00 PM - 8:00 PM' WHEN 2 THEN 'Flexible'
       WHEN 3 THEN '4:00 PM - 2:00 AM (next day)' WHEN 4 THEN NULL WHEN 5 THEN '15:00'
       WHEN 6 THEN '10:00 AM - 11:30 PM, self check-in' ELSE '3:00 PM - 9:00 PM' END AS checkin,
  CASE o.o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '10:00 AM' WHEN 2 THEN '12:00 PM' ELSE '11:00 AM' END AS checkout,
  CASE WHEN o.o_orderkey % 6 = 0 THEN NULL WHEN o.o_orderkey % 61 = 0 THEN '3f' ELSE CAST(1 + o.o_orderkey % 5 AS STRING) END AS minimum_stay,
  CASE WHEN o.o_orderkey % 63 = 0 THEN NULL ELSE '[' || chr(39) || 'TV' || chr(39) || ', ' || chr(39) || 'Wifi' || chr(39)
      || CASE WHEN o.o_orderkey % 2 = 0 THEN ',Heating' ELSE '' END || ']' END AS amenities,
  CASE WHEN o.o_orderkey % 43 = 0 THEN NULL ELSE
       CAST(o.o_orderkey % 180 - 90 AS STRING) || '.' || LPAD(CAST(o.o_orderkey % 100 AS STRING), 2, '0') END AS latitude,
  CASE WHEN o.o_orderkey % 47 = 0 THEN NULL ELSE
       CAST(o.o_custkey % 360 - 180 AS STRING) || '.' || LPAD(CAST(o.o_orderkey % 97 AS STRING), 2, '0') END AS longitude,
  CASE WHEN o.o_orderkey % 10 < 3 THEN NULL ELSE LPAD(CAST(o.o_orderkey % 9973 AS STRING), 5, '0') END AS zipcode,
  CASE WHEN o.o_orderkey % 4 = 1 THEN NULL ELSE CAST(o.o_orderkey % 11 AS STRING) END AS location_rating,
  CASE WHEN o.o_orderkey % 4 = 2 THEN NULL WHEN o.o_orderkey % 67 = 0 THEN 'Infinity' WHEN o.o_orderkey % 71 = 0 THEN 'NaN'
       ELSE CAST(o.o_orderkey % 5 AS STRING) || '.25' END AS overall_rating,
  CASE WHEN o.o_orderkey % 8 = 3 THEN NULL ELSE CAST(CAST(c.c_acctbal AS DECIMAL(14,2)) AS STRING) END AS cleaning_fee,
  CASE WHEN o.o_orderkey % 6 = 5 THEN NULL ELSE CAST(o.o_orderkey % 101 AS STRING) END AS occupancy,
  CASE WHEN o.o_orderkey % 12 = 7 THEN NULL ELSE CAST(CAST(o.o_totalprice AS DECIMAL(14,2)) AS STRING) END AS revenue,
  CASE WHEN o.o_custkey % 10 = 9 THEN NULL ELSE CAST(1 + o.o_custkey % 7 AS STRING) END AS host_listing_count,
  CASE WHEN o.o_orderkey % 5 = 1 THEN NULL ELSE 'Own ' || n.n_name END AS country,
  CASE WHEN o.o_orderkey % 5 = 2 THEN NULL ELSE 'State ' || CAST(o.o_orderkey % 8 AS STRING) END AS state,
  CASE WHEN o.o_orderkey % 5 = 3 THEN NULL ELSE 'City ' || CAST(o.o_orderkey % 12 AS STRING) END AS city,
  CASE WHEN o.o_orderkey % 5 = 4 THEN NULL WHEN o.o_orderkey % 2 = 0 THEN 'CHF' ELSE 'SEK' END AS currency,
  CASE WHEN o.o_orderkey % 6 = 1 THEN NULL ELSE CAST(o.o_orderkey % 301 AS STRING) END AS number_of_reviews,
  CASE WHEN o.o_orderkey % 7 = 1 THEN NULL ELSE CAST(1 + o.o_orderkey % 9 AS STRING) END AS max_guests,
  CASE o.o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Strict' WHEN 2 THEN 'Moderate' ELSE 'Flexible ☂' END AS cancellation_policy,
  CASE WHEN o.o_orderkey % 7 = 2 THEN NULL ELSE CAST(o.o_orderkey % 90 AS STRING) || '.75' END AS cleaning_fee_native,
  CASE WHEN o.o_orderkey % 7 = 3 THEN NULL ELSE CAST(o.o_orderkey % 40 AS STRING) || '.5' END AS extra_fee_native,
  CASE WHEN o.o_orderkey % 7 = 4 THEN NULL ELSE ' ' || CAST(o.o_orderkey % 30 AS STRING) END AS extra_fee_usd,
  CASE o.o_orderkey % 5 WHEN 0 THEN 't' WHEN 1 THEN 'f' WHEN 2 THEN 'T' ELSE NULL END AS exact_location,
  CASE WHEN o.o_orderkey % 8 = 1 THEN NULL ELSE CAST(o.o_orderkey % 10 AS STRING) END AS accuracy_rating,
  CASE WHEN o.o_orderkey % 8 = 2 THEN NULL ELSE CAST(o.o_orderkey % 9 AS STRING) END AS communication_rating,
  CASE WHEN o.o_orderkey % 8 = 4 THEN NULL ELSE CAST(o.o_orderkey % 8 AS STRING) END AS value_rating,
  CASE WHEN o.o_orderkey % 8 = 5 THEN NULL ELSE CAST(o.o_orderkey % 7 AS STRING) || '.9' END AS checkin_rating,
  CASE WHEN o.o_orderkey % 8 = 6 THEN NULL ELSE '1e' || CAST(o.o_orderkey % 2 AS STRING) END AS cleanliness_rating,
  CASE WHEN o.o_orderkey % 9 = 1 THEN NULL ELSE 'pics/' || CAST(o.o_orderkey AS STRING) || '.jpg' END AS picture,
  CASE WHEN o.o_orderkey % 9 = 2 THEN NULL ELSE 'LIC-' || CAST(o.o_custkey AS STRING) END AS license,
  CASE WHEN o.o_orderkey % 9 = 4 THEN NULL ELSE 'no smoking' END AS guest_controls,
  CASE o.o_orderkey % 6 WHEN 0 THEN 't' WHEN 1 THEN 'f' WHEN 2 THEN 'true' ELSE NULL END AS pets_allowed,
  CASE WHEN o.o_orderkey % 9 = 5 THEN NULL ELSE 'rooms/' || CAST(o.o_orderkey AS STRING) END AS listing_url,
  CASE o.o_orderkey % 7 WHEN 0 THEN 't' WHEN 1 THEN 'f' ELSE NULL END AS instantbook_enabled,
  CASE WHEN o.o_orderkey % 10 = 1 THEN NULL ELSE CAST(o.o_orderkey % 366 AS STRING) END AS available_days,
  CASE WHEN o.o_orderkey % 10 = 2 THEN NULL ELSE CAST(o.o_orderkey % 120 AS STRING) END AS blocked_days,
  CASE WHEN o.o_orderkey % 10 = 4 THEN NULL ELSE CAST(o.o_orderkey % 200 AS STRING) END AS reservation_days,
  CASE WHEN o.o_orderkey % 10 = 6 THEN NULL ELSE CAST(o.o_orderkey % 50 AS STRING) END AS bookings,
  CASE WHEN o.o_orderkey % 10 = 7 THEN NULL ELSE CAST(o.o_orderkey % 12 AS STRING) END AS bookings_months,
  CASE WHEN o.o_orderkey % 11 = 1 THEN NULL ELSE CAST(o.o_orderkey % 500 AS STRING) || '.125' END AS daily_rate_native,
  CASE WHEN o.o_orderkey % 11 = 2 THEN NULL ELSE '-' || CAST(o.o_orderkey % 400 AS STRING) || '.5' END AS daily_rate_usd,
  CASE WHEN o.o_orderkey % 11 = 3 THEN NULL ELSE CAST(o.o_orderkey % 9999 AS STRING) || '.01' END AS revenue_native
FROM {orders_copies} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

# Column of the dirty view -> header of the raw listing file.
RAW_HEADERS: dict[str, str] = {
    "property_id": "Airbnb Property ID",
    "host_id": "Airbnb Host ID",
    "title": "Listing Title",
    "property_type": "Property Type",
    "listing_type": "Listing Type",
    "bedrooms": "Bedrooms",
    "bathrooms": "Bathrooms",
    "created": "Created Date",
    "superhost": "Airbnb Superhost",
    "instant_bookable": "instant_bookable",
    "checkin": "Check-in Time",
    "checkout": "Checkout Time",
    "minimum_stay": "Minimum Stay",
    "amenities": "Amenities",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "zipcode": "Zipcode",
    "location_rating": "Airbnb Location Rating",
    "overall_rating": "Overall Rating",
    "cleaning_fee": "Cleaning Fee (USD)",
    "occupancy": "Occupancy Rate LTM",
    "revenue": "Annual Revenue LTM (USD)",
    "host_listing_count": "Host Listing Count",
    "country": "Country",
    "state": "State",
    "city": "City",
    "currency": "Currency Native",
    "number_of_reviews": "Number of Reviews",
    "max_guests": "Max Guests",
    "cancellation_policy": "Cancellation Policy",
    "cleaning_fee_native": "Cleaning Fee (Native)",
    "extra_fee_native": "Extra People Fee(Native)",
    "extra_fee_usd": "Extra People Fee (USD)",
    "exact_location": "Exact Location",
    "accuracy_rating": "Airbnb Accuracy Rating",
    "communication_rating": "Airbnb Communication Rating",
    "value_rating": "Airbnb Value Rating",
    "checkin_rating": "Airbnb Checkin Rating",
    "cleanliness_rating": "Airbnb Cleanliness Rating",
    "picture": "picture_url",
    "license": "License",
    "guest_controls": "guest_controls",
    "pets_allowed": "Pets Allowed",
    "listing_url": "Listing URL",
    "instantbook_enabled": "Instantbook Enabled",
    "available_days": "Count Available Days LTM",
    "blocked_days": "Count Blocked Days LTM",
    "reservation_days": "Count Reservation Days LTM",
    "bookings": "Number of Bookings LTM",
    "bookings_months": "Number of Bookings LTM - Number of observed month",
    "daily_rate_native": "Average Daily Rate (Native)",
    "daily_rate_usd": "Average Daily Rate (USD)",
    "revenue_native": "Annual Revenue LTM (Native)",
}

# Per-source constants and id prefixes, one row per nation.  Some sources
# leave state, city or currency unset, as the listing sources do.
SOURCES_SQL = """
SELECT 'city' || LPAD(CAST(n_nationkey AS STRING), 2, '0') AS src,
       'C' || LPAD(CAST(n_nationkey AS STRING), 2, '0') AS prefix,
       n_name AS country,
       CASE WHEN n_regionkey % 2 = 0 THEN 'Region ' || CAST(n_regionkey AS STRING) END AS state,
       CASE WHEN n_nationkey % 3 = 0 THEN 'Town ' || CAST(n_nationkey AS STRING) END AS city,
       CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' END AS currency,
       CASE n_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS translate, n_nationkey % 2 = 0 AS geocode
FROM {nation}
"""

# Reference points for reverse geocoding, one per nation.
POSTCODE_POINTS_SQL = """
SELECT 'P' || LPAD(CAST(n_nationkey AS STRING), 3, '0') AS postcode,
       CAST((n_nationkey * 37) % 170 - 85 AS DOUBLE) + 0.5 AS lat,
       CAST((n_nationkey * 73) % 360 - 180 AS DOUBLE) + 0.25 AS lon
FROM {nation}
"""

# Geocoder answers, one per order: postal code in the first result, in the
# second result, no results, malformed text, and an object without results.
GEOCODER_PAYLOADS_SQL = """
SELECT CAST(o_orderkey AS STRING) AS property_id,
  CASE o_orderkey % 5
    WHEN 0 THEN '{{"results":[]}}'
    WHEN 1 THEN '{{"results":[{{"address_components":[{{"long_name":"' || o_orderpriority
                || '","types":["route"]}},{{"long_name":"' || LPAD(CAST(o_custkey % 100000 AS STRING), 5, '0')
                || '","types":["postal_code"]}}]}}]}}'
    WHEN 2 THEN '{{"results":[{{"address_components":[{{"long_name":"' || o_orderstatus
                || '","types":["locality","political"]}}]}},{{"address_components":[{{"long_name":"Z'
                || CAST(o_orderkey % 997 AS STRING) || '","types":["postal_code","political"]}}]}}]}}'
    WHEN 3 THEN '{{"results":[{{"address_components":[{{"long_name":"x","types":["route"]}}]}}'
    ELSE '{{"status":"ZERO_RESULTS"}}'
  END AS payload
FROM {orders}
"""

# Texts with every seventh conversation (or eleventh document) written in another script, letter by letter.
JAPANESE = "translate({text}, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
    "'あいうえおかきくけこさしすせそたちつてと東京都市家族海山アイウエオカキクケコサシスセソタチツテト大小中上下右左')"
ARABIC = "translate({text}, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
    "'ابتثجحخدذرزسشصضطظعغفقكلمنهابتثجحخدذرزسشصضطظعغفقكلمنه')"
TALK_SQL = f"""
SELECT conv_id, turn, role,
       CASE conv_id % 7 WHEN 3 THEN {JAPANESE.format(text="text")} WHEN 5 THEN {ARABIC.format(text="text")} ELSE text END AS text
FROM {{conversations}}
"""
DOCUMENTS_SQL = f"""
SELECT doc_id, lang,
       CASE doc_id % 11 WHEN 4 THEN {JAPANESE.format(text="text")} WHEN 7 THEN {ARABIC.format(text="text")} ELSE text END AS text
FROM {{documents}}
"""

# Translation memo: earlier answers of a translation service, keyed by the
# source text.  Stands in for the service's cache; covers the user turns.
TRANSLATION_MEMO_SQL = """
SELECT text AS source_text,
       MIN('en:' || CAST(conv_id AS STRING) || '.' || CAST(turn AS STRING)) AS translated
FROM {talk}
WHERE role = 'user'
GROUP BY text
"""


# Translations of listing titles, one per title that the service has seen.
TITLE_MEMO_SQL = """
SELECT DISTINCT 'Belle maison ' || CAST(o_orderkey % 50 AS STRING) AS source_text,
       'Nice house ' || CAST(o_orderkey % 50 AS STRING) AS translated FROM {orders} WHERE o_orderkey % 14 = 1
UNION ALL
SELECT DISTINCT '東京の家 ' || CAST(o_orderkey % 50 AS STRING), 'House in Tokyo ' || CAST(o_orderkey % 50 AS STRING)
FROM {orders} WHERE o_orderkey % 14 = 3 AND o_orderkey % 50 < 40
"""


# Orders with the planted copies: every order once, orders with key % 10 = 0 twice.
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDERS_COPIES_SQL = (
    "(SELECT {cols} FROM orders UNION ALL SELECT {cols} FROM orders WHERE o_orderkey % 10 = 0)"
    .format(cols=", ".join(ORDER_COLUMNS)))


def duckdb_sql(template: str) -> str:
    """The template with DuckDB's pre-registered view names."""
    return template.format(orders="orders", customer="customer", nation="nation",
                           conversations="conversations", documents="documents", talk="talk",
                           orders_copies=ORDERS_COPIES_SQL)


# Customers up to which they are broadcast to the orders; beyond, both are dealt out by customer.
BROADCAST_CUSTOMERS = 250_000


def orders_copies(orders: DataFrame) -> DataFrame:
    """The same rows as ``ORDERS_COPIES_SQL`` from one scan: the copy is an explode."""
    o = orders
    copies = F.when(F.col("o_orderkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return o.select(*ORDER_COLUMNS, F.explode(copies).alias("_copy")).drop("_copy")


# Fact-sized tables: spread over the cores when their scan is one split.
LARGE_TABLES = {"orders", "documents", "conversations"}


def _spark_sql(spark: SparkSession, sf_dir: str, template: str, tables: list[str]) -> DataFrame:
    frames = {t: read_table(spark, sf_dir, t, spread_rows=t in LARGE_TABLES) for t in tables}
    return spark.sql(template, **frames)


def dirty_listings(spark: SparkSession, sf_dir: str, rows_per_task: int | None = None) -> DataFrame:
    """The dirty listing view, all columns text except ``src_no``; a task makes about ``rows_per_task`` orders wide."""
    orders, customer = read_table(spark, sf_dir, "orders").select(*ORDER_COLUMNS), read_table(spark, sf_dir, "customer")
    tasks = tasks_for(orders) if rows_per_task is None else tasks_for(orders, rows_per_task)
    if customer.count() <= BROADCAST_CUSTOMERS:
        orders, customer = orders.repartition(tasks), F.broadcast(customer)
    else:  # the join then adds no shuffle of its own, which would be cut by its narrow bytes
        orders = orders.repartition(tasks, "o_custkey")
        customer = customer.select("c_custkey", "c_nationkey", "c_acctbal").repartition(tasks, "c_custkey")
    listings = spark.sql(DIRTY_LISTINGS_SQL, orders_copies=orders_copies(orders), customer=customer, nation=F.broadcast(read_table(spark, sf_dir, "nation")))
    return listings.withColumn("src", split_compiled(F.col("src")))


def raw_listings(spark: SparkSession, sf_dir: str, rows_per_task: int | None = None) -> DataFrame:
    """Dirty listings under the raw file headers, plus the ``src`` lineage column."""
    df = dirty_listings(spark, sf_dir, rows_per_task)
    return df.select("src", *[df[c].alias(h) for c, h in RAW_HEADERS.items()])


def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, SOURCES_SQL, ["nation"])


def postcode_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, POSTCODE_POINTS_SQL, ["nation"])


def geocoder_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, GEOCODER_PAYLOADS_SQL, ["orders"])


def talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, TALK_SQL, ["conversations"])


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, DOCUMENTS_SQL, ["documents"])


def title_memo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, TITLE_MEMO_SQL, ["orders"])


def translation_memo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TRANSLATION_MEMO_SQL, talk=talk(spark, sf_dir))
