"""DuckDB SQL oracles, one per registered query.

Written independently of the Spark plans: plain SQL over the driver's views
(``orders customer nation documents conversations``), composed as a chain
of CTEs.  Patterns, defaults, flags, modes and word lists are stated here
again, so that a wrong constant of the engine shows; only the names and types
of columns (the mapping and the table layouts) are taken from the
configuration.  ``row_number()``, cross joins and scalar subqueries are fine
here -- the oracle only has to be right on small data.
"""

from __future__ import annotations

from ..config import COLUMN_MAPPING, TABLE_COLUMNS, TARGET_TYPES
from ..fixtures import (DIRTY_LISTINGS_SQL, DOCUMENTS_SQL, GEOCODER_PAYLOADS_SQL, POSTCODE_POINTS_SQL,
                        RAW_HEADERS, SOURCES_SQL, TALK_SQL, TITLE_MEMO_SQL, TRANSLATION_MEMO_SQL, duckdb_sql)
from ..functions.language import SAMPLES

# Fixed values, stated on their own.
ID_CODES = {"listingId": "LIS", "amenitiesId": "AMT", "reviewId": "REV", "checkInOutId": "CHK", "locationId": "LOC",
            "pricingId": "PRC", "bookingId": "BOK"}
COMMON_MISSING = ["propertyType", "listingType", "bedrooms"]
FLAG_COLUMNS = {"listing": ["instantBookable", "petsAllowed"], "location": ["exactLocation"], "host": ["superhost"],
                "booking": ["instantBookEnabled"]}
FILL_DEFAULTS = {
    "listing": {"propertyId": "0", "listingTitle": "Unknown", "propertyType": "Not Specified",
                "listingType": "Not Specified", "listingURL": "No URL", "pictureURL": "No Image",
                "createdDate": "1970-01-01", "bedrooms": 1, "bathrooms": 1, "maxGuests": 2,
                "cancellationPolicy": "Not Specified"},
    "location": {"country": "Unknown", "state": "Unknown", "city": "Unknown", "zipcode": "000000", "latitude": 0,
                 "longitude": 0},
    "host": {"hostId": "0", "hostListingCount": 0},
    "review": {"numberOfReviews": 0, "overallRating": 0, "communicationRating": 0, "accuracyRating": 0,
               "cleanlinessRating": 0, "checkinRating": 0, "locationRating": 0, "valueRating": 0},
    "checkin": {"minimumStay": 1},
    "pricing": {"currencyNative": "0.0", "cleaningFeeUSD": 0, "cleaningFeeNative": 0, "extraPeopleFeeUSD": 0,
                "extraPeopleFeeNative": 0, "averageDailyRateUSD": 0, "averageDailyRateNative": 0},
    "booking": {"occupancyRateLtm": 0, "numberOfBookingsLtm": 0, "numberOfBookingsLtmObservedMonth": 0,
                "countReservationDaysLtm": 0, "countAvailableDaysLtm": 0, "annualRevenueLtmUSD": 0,
                "annualRevenueLtmNative": 0},
}
MODE_COLUMNS = ["checkoutTime", "checkinStartTime", "checkinEndTime"]
FLEXIBLE_TIME = "12:00 AM"
CLOCK_PREFIX = "^\\s*(\\d{1,2}:\\d{2} [AaPp][Mm])"
SYMBOL_CLASS = ("[\U0001F600-\U0001F64F\U0001F300-\U0001F5FF\U0001F680-\U0001F6FF\U0001F1E0-\U0001F1FF\u2700-\u27BF"
                "\u2600-\u26FF\u2B00-\u2BFF\U0001F100-\U0001F1FF\U0001F200-\U0001F2FF\U0001F900-\U0001F9FF\u25A0-\u25FF]")
PLAIN_TEXT_PATTERN = "^[a-zA-Z0-9\\s\\.,!?'\"-]+$"
NUMBER_PATTERN = "^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$"
# Letter groups of a language's profile: buckets and the lead that a language needs.
BUCKETS, LEAD = 8192, 50
# Language -> classes of its letters; Han is Japanese beside a syllable, else Chinese.
SCRIPTS = {"ar": "\\p{Arabic}", "el": "\\p{Greek}", "he": "\\p{Hebrew}", "hi": "\\p{Devanagari}", "ja": "\\p{Hiragana}\\p{Katakana}",
           "ko": "\\p{Hangul}", "ru": "\\p{Cyrillic}", "th": "\\p{Thai}", "zh": "\\p{Han}"}
TARGET_LANGUAGE = "en"
DROPPED_HEADERS = ["Zipcode", "Bedrooms", "Amenities"]
POSTCODE_RADIUS_KM = 1500.0

DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
              "boolean": "BOOLEAN"}
HEADER_TO_DIRTY = {h: c for c, h in RAW_HEADERS.items()}
DIRTY_COLUMNS = ["src_no", "src", *RAW_HEADERS]
ID_TYPES = {name: "string" for name in ID_CODES}


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def with_(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in ctes) + "\n" + body


def number_sql(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {q(NUMBER_PATTERN)}) THEN TRY_CAST({c} AS DOUBLE) END"


def cast_sql(c: str, typ: str) -> str:
    if typ == "string":
        return c
    if typ == "int":
        return f"TRY_CAST(trunc({number_sql(c)}) AS INTEGER)"
    if typ == "double":
        return number_sql(c)
    if typ == "date":
        return f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"
    raise ValueError(typ)


def mapped_sql(dropped: tuple[str, ...] = (), ensure: bool = True) -> str:
    cols = ["src"]
    for raw, target, typ in COLUMN_MAPPING:
        d = HEADER_TO_DIRTY.get(raw)
        if d and raw not in dropped:
            cols.append(f"{cast_sql(d, typ)} AS {target}")
        elif ensure:
            cols.append(f"CAST(NULL AS {DUCK_TYPES[typ]}) AS {target}")
    return "SELECT " + ", ".join(cols) + " FROM dirty"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, {q(SYMBOL_CLASS)}, ' ', 'g')"


def flag_sql(c: str) -> str:
    return f"COALESCE({c} = 't', false)"


def literal_sql(v: object, typ: str) -> str:
    if isinstance(v, bool):
        lit = "true" if v else "false"
    elif isinstance(v, str):
        lit = q(v)
    else:
        lit = repr(v)
    return f"CAST({lit} AS {DUCK_TYPES[typ]})"


def clock_sql(c: str) -> str:
    return f"strftime(try_strptime(regexp_extract({c}, {q(CLOCK_PREFIX)}, 1), '%I:%M %p'), '%H:%M')"


def amenity_list_sql(c: str) -> str:
    pieces = f"string_split_regex(trim({c}), ',\\s*')"
    cleaned = f"list_transform({pieces}, lambda p: trim(regexp_replace(trim(p), '[\\[\\]'']', '', 'g')))"
    return f"list_filter({cleaned}, lambda p: p <> '')"


def cents_sql(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(14,2)) * 100 AS BIGINT)"


def avg_money_sql(s: str, n: str) -> str:
    qq = (f"CASE WHEN {s} >= 0 THEN ({s} * 2 + {n}) // ({n} * 2) "
          f"ELSE -((-{s} * 2 + {n}) // ({n} * 2)) END")
    return f"CAST(CAST({qq} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


def col_type(c: str) -> str:
    return TARGET_TYPES.get(c) or ID_TYPES.get(c) or "string"


# ---------------------------------------------------------------------------
# CTE chain
# ---------------------------------------------------------------------------

BASE = [("dirty", duckdb_sql(DIRTY_LISTINGS_SQL)), ("sources", duckdb_sql(SOURCES_SQL))]
MAPPED = BASE + [("mapped", mapped_sql())]
NOT_EMPTY = "NOT (" + " AND ".join(f"{c} IS NULL" for c in COMMON_MISSING) + ")"
CLEANED = MAPPED + [("cleaned", f"SELECT DISTINCT * FROM mapped WHERE {NOT_EMPTY}")]
STRIPPED_COLS = ", ".join(["src"] + [f"{strip_sql(c)} AS {c}" if t == "string" else c
                                     for c, t in TARGET_TYPES.items()])
CONST_MAP = {"country": "country", "state": "state", "city": "city", "currencyNative": "currency"}


def constants_sql(frm: str, keep: bool = False) -> str:
    cols = ["m.src"]
    for c in TARGET_TYPES:
        if c in CONST_MAP:
            k = f"k.{CONST_MAP[c]}"
            cols.append(f"COALESCE({k}, m.{c}) AS {c}" if keep else f"{k} AS {c}")
        else:
            cols.append(f"m.{c}")
    return f"SELECT {', '.join(cols)}, k.prefix AS _prefix FROM {frm} m LEFT JOIN sources k ON m.src = k.src"


IDS = ", ".join(f"_prefix || {q(code)} || CAST(_rn AS VARCHAR) AS {name}" for name, code in ID_CODES.items())
# Rows of one property id (or none) are ordered by a digest of their texts, then by all columns.
TEXTS = ["propertyId"] + [c for c, t in TARGET_TYPES.items() if t == "string" and c != "propertyId"]
ROW_ORDER = ("propertyId NULLS FIRST, md5(concat_ws(chr(31), "
             + ", ".join(f"coalesce({c}, '')" for c in TEXTS) + ")), "
             + ", ".join(f"{c} NULLS FIRST" for c in TARGET_TYPES if c != "propertyId"))
WIDE = CLEANED + [
    ("stripped", f"SELECT {STRIPPED_COLS} FROM cleaned"),
    ("constant", constants_sql("stripped")),
    ("numbered", f"SELECT *, row_number() OVER (PARTITION BY src ORDER BY {ROW_ORDER}) AS _rn FROM constant"),
    ("wide", f"SELECT * EXCLUDE (_prefix, _rn), {IDS} FROM numbered"),
]


def fill_cols(table: str, cols: list[str]) -> list[str]:
    flags = set(FLAG_COLUMNS.get(table, []))
    defaults = FILL_DEFAULTS[table]
    out = []
    for c in cols:
        if c in flags:
            out.append(f"{flag_sql(c)} AS {c}")
        elif c in defaults:
            out.append(f"COALESCE({c}, {literal_sql(defaults[c], col_type(c))}) AS {c}")
        else:
            out.append(c)
    return out


def listing_cols(cols: list[str]) -> list[str]:
    out = []
    for expr, c in zip(fill_cols("listing", cols), cols):
        out.append(f"replace(COALESCE(listingTitle, 'Unknown'), chr(39), '') AS listingTitle"
                   if c == "listingTitle" else expr)
    return out


def booking_cols(cols: list[str]) -> list[str]:
    out = []
    for expr, c in zip(fill_cols("booking", cols), cols):
        out.append("COALESCE(hostId, '0') AS hostId" if c == "hostId" else expr)
    return out + ["annualRevenueLtmUSD IS NOT NULL AS revenueKnown"]


def checkin_ctes(frm: str, keys: list[str]) -> list[tuple[str, str]]:
    """Split, modes, fill and clock for the check-in columns of ``frm``."""
    k = ", ".join(keys)
    split0 = (f"SELECT {k}, checkoutTime, minimumStay, "
              f"regexp_replace(string_split(checkinTime, ',')[1], 'After\\s', '', 'g') AS _t FROM {frm}")
    split1 = f"SELECT *, trim(string_split(_t, '-')[1]) AS _s, trim(string_split(_t, '-')[2]) AS _e FROM ck0"
    split2 = (f"SELECT {k}, checkoutTime, minimumStay, "
              f"regexp_replace(_s, 'Flexible', {q(FLEXIBLE_TIME)}, 'g') AS checkinStartTime, "
              f"CASE WHEN _s = 'Flexible' THEN {q(FLEXIBLE_TIME)} ELSE _e END AS checkinEndTime FROM ck1")
    return [("ck0", split0), ("ck1", split1), ("ck_split", split2)]


def mode_sql(c: str, frm: str = "ck_split") -> str:
    return (f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM {frm} WHERE {c} IS NOT NULL GROUP BY 1) "
            f"ORDER BY n DESC, v LIMIT 1)")


def checkin_filled(keys: list[str]) -> str:
    cols = list(keys)
    cols.append(f"{clock_sql(f'COALESCE(checkoutTime, {mode_sql('checkoutTime')})')} AS checkoutTime")
    cols.append(f"COALESCE(minimumStay, {literal_sql(FILL_DEFAULTS['checkin']['minimumStay'], 'int')}) "
                f"AS minimumStay")
    for c in ("checkinStartTime", "checkinEndTime"):
        cols.append(f"{clock_sql(f'COALESCE({c}, {mode_sql(c)})')} AS {c}")
    return "SELECT " + ", ".join(cols) + " FROM ck_split"


T = TABLE_COLUMNS
TABLES = WIDE + checkin_ctes("wide", ["checkInOutId"]) + [
    ("t_listing", f"SELECT {', '.join(listing_cols(T['listing']))} FROM wide"),
    ("t_host", "SELECT COALESCE(hostId, '0') AS hostId, "
               "COALESCE(max(hostListingCount), CAST(0 AS INTEGER)) AS hostListingCount, "
               "COALESCE(max(CASE WHEN superhost = 't' THEN 't' WHEN superhost = 'f' THEN 'f' END) = 't', false) "
               "AS superhost FROM wide GROUP BY COALESCE(hostId, '0')"),
    ("t_location", f"SELECT {', '.join(fill_cols('location', T['location']))} FROM wide"),
    ("t_amenities", f"SELECT {', '.join(T['amenities'])} FROM wide"),
    ("t_review", f"SELECT {', '.join(fill_cols('review', T['review']))} FROM wide"),
    ("t_checkin", checkin_filled(["checkInOutId"])),
    ("t_pricing", f"SELECT {', '.join(fill_cols('pricing', T['pricing']))} FROM wide"),
    ("t_booking", f"SELECT {', '.join(booking_cols(T['booking']))}, src FROM wide"),
]

ROW_KEY = ["src", "propertyId"]


def _fill_oracle(table: str) -> str:
    cols = [c for c in T[table] if not c.endswith("Id") or c in ("propertyId", "hostId")]
    keep = [c for c in ROW_KEY if c not in cols]
    if table == "listing":
        exprs = listing_cols(cols)
    elif table == "booking":
        exprs = booking_cols(cols)
    else:
        exprs = fill_cols(table, cols)
    return with_(MAPPED, f"SELECT {', '.join(keep + exprs)} FROM mapped")


# ---------------------------------------------------------------------------
# Language detection (tokens joined to the stop words, top-1 per text)
# ---------------------------------------------------------------------------

SAMPLE_VALUES = ", ".join(f"({q(lang)}, {q(text)})" for lang, text in SAMPLES.items())


def groups_sql(text: str) -> str:
    """List of the buckets of all groups of two to four letters; empty without letters."""
    words = f"trim(regexp_replace(lower({text}), '(?:[^\\p{{L}}]|[\\x{{10000}}-\\x{{10FFFF}}])+', ' ', 'g'))"
    codes = f"list_transform(string_split(' ' || {words} || '  ', ''), lambda c: unicode(c))"
    return (f"CASE WHEN {words} = '' THEN [] ELSE list_transform([{codes}], lambda c: list_concat(list_concat("
            f"list_transform(range(1, len(c)), lambda i: (c[i] * 31 + c[i + 1]) % {BUCKETS}), "
            f"list_transform(range(1, len(c) - 1), lambda i: (c[i] * 961 + c[i + 1] * 31 + c[i + 2] + 7) % {BUCKETS})), "
            f"list_transform(range(1, len(c) - 2), lambda i: (c[i] * 29791 + c[i + 1] * 961 + c[i + 2] * 31 + c[i + 3] + 13) % {BUCKETS})))[1] END")


def letters_sql(text: str, classes: str) -> str:
    return f"length(regexp_replace({text}, '[^{classes}]', '', 'g'))"


def language_ctes(table: str, key: list[str], text: str = "text", name: str = "") -> list[tuple[str, str]]:
    """``best<name>``: the language of each text, by script or by letter groups."""
    k = ", ".join(key)
    kana, han = letters_sql(text, SCRIPTS["ja"]), letters_sql(text, SCRIPTS["ja"] + SCRIPTS["zh"])
    counts = {lang: letters_sql(text, classes) for lang, classes in SCRIPTS.items()}
    counts["ja"] = f"CASE WHEN {kana} > 0 THEN {han} ELSE 0 END"
    counts["zh"] = f"CASE WHEN {kana} > 0 THEN 0 ELSE {counts['zh']} END"
    scripts = " UNION ALL ".join(f"SELECT {k}, {q(lang)} AS lang, {n} AS n, {letters_sql(text, chr(92) + 'p{Latin}')} AS latin FROM {table}"
                                 for lang, n in counts.items())
    top = "row_number() OVER (PARTITION BY {} ORDER BY n DESC, lang) AS rn".format(k)
    return [
        (f"sample{name}", f"SELECT lang, unnest({groups_sql('text')}) AS bucket FROM (VALUES {SAMPLE_VALUES}) AS s(lang, text)"),
        (f"seen{name}", f"SELECT lang, bucket, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang) AS total FROM sample{name} GROUP BY lang, bucket"),
        (f"profile{name}", f"SELECT lang, bucket, round(100 * ln((n + 0.5) / (total + {BUCKETS / 2})))::BIGINT "
                           f"- round(100 * ln(0.5 / (total + {BUCKETS / 2})))::BIGINT AS gain FROM seen{name}"),
        (f"rare{name}", f"SELECT DISTINCT lang, round(100 * ln(0.5 / (total + {BUCKETS / 2})))::BIGINT AS rare FROM seen{name}"),
        (f"own{name}", f"SELECT {k}, list_distinct({groups_sql(text)}) AS g FROM {table}"),
        (f"hits{name}", f"SELECT {k}, lang, sum(gain) AS gain FROM (SELECT {k}, unnest(g) AS bucket FROM own{name}) "
                        f"JOIN profile{name} USING (bucket) GROUP BY {k}, lang"),
        (f"scores{name}", f"SELECT {k}, r.lang, len(o.g) * r.rare + coalesce(h.gain, 0) AS n FROM own{name} o CROSS JOIN rare{name} r "
                          f"LEFT JOIN hits{name} h USING ({k}, lang) WHERE len(o.g) > 0"),
        (f"word{name}", f"SELECT {k}, lang FROM (SELECT *, {top}, lead(n) OVER (PARTITION BY {k} ORDER BY n DESC, lang) AS next FROM scores{name}) "
                        f"WHERE rn = 1 AND n - next >= {LEAD}"),
        (f"script{name}", f"SELECT {k}, lang FROM (SELECT *, {top} FROM ({scripts})) WHERE rn = 1 AND n > latin AND n > 0"),
        (f"best{name}", f"SELECT {k}, coalesce(s.lang, w.lang) AS lang FROM script{name} s FULL JOIN word{name} w USING ({k})"),
    ]


def _translate_ctes() -> list[tuple[str, str]]:
    return [("talk", duckdb_sql(TALK_SQL)), ("memo", duckdb_sql(TRANSLATION_MEMO_SQL))] + language_ctes("talk", ["conv_id", "turn"])


NEEDS = f"b.lang IS NOT NULL AND b.lang <> {q(TARGET_LANGUAGE)}"
TRANSLATED = f"CASE WHEN {NEEDS} THEN COALESCE(m.translated, c.text) ELSE c.text END"
TRANSLATE_FROM = ("FROM talk c LEFT JOIN best b ON c.conv_id = b.conv_id AND c.turn = b.turn "
                  "LEFT JOIN memo m ON c.text = m.source_text")


def _gate_rows(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {q(table)} AS tbl, {q(c)} AS column_name, "
        f"count_if(NOT regexp_matches({c}, {q(PLAIN_TEXT_PATTERN)})) AS n_failing FROM {table}"
        for c in cols)


def _translate_gated() -> str:
    cols = []
    for c in ("role", "text"):
        gate = (f"(SELECT count_if(NOT regexp_matches({c}, {q(PLAIN_TEXT_PATTERN)})) FROM talk) > 0")
        # The memo lookup of a gated column uses that column's own language and memo entry.
        cols.append(f"CASE WHEN {gate} THEN {c}_tr ELSE c.{c} END AS {c}")
    per_col = []
    for c in ("role", "text"):
        per_col += language_ctes("talk", ["conv_id", "turn"], c, f"_{c}")
    body = (f"SELECT c.conv_id, c.turn, {', '.join(cols)} FROM ("
            "SELECT c.*, "
            + ", ".join(
                f"CASE WHEN b_{c}.lang IS NOT NULL AND b_{c}.lang <> {q(TARGET_LANGUAGE)} "
                f"THEN COALESCE(m_{c}.translated, c.{c}) ELSE c.{c} END AS {c}_tr" for c in ("role", "text"))
            + " FROM talk c "
            + " ".join(f"LEFT JOIN best_{c} b_{c} ON c.conv_id = b_{c}.conv_id AND c.turn = b_{c}.turn "
                       f"LEFT JOIN memo m_{c} ON c.{c} = m_{c}.source_text" for c in ("role", "text"))
            + ") c")
    return with_([("talk", duckdb_sql(TALK_SQL)), ("memo", duckdb_sql(TRANSLATION_MEMO_SQL))] + per_col, body)


# ---------------------------------------------------------------------------
# Nearest postcode: every pair, exact distance, top-1
# ---------------------------------------------------------------------------

def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)")
    return f"2 * 6371.0 * asin(least(1.0, sqrt({a})))"


def _nearest() -> str:
    ctes = MAPPED + [
        ("points", duckdb_sql(POSTCODE_POINTS_SQL)),
        ("listings", "SELECT row_number() OVER () AS _row, src, propertyId, latitude, longitude FROM mapped"),
        ("pairs", f"SELECT l._row, p.postcode, {haversine_sql('l.latitude', 'l.longitude', 'p.lat', 'p.lon')} AS d "
                  f"FROM listings l CROSS JOIN points p WHERE l.latitude IS NOT NULL AND l.longitude IS NOT NULL"),
        ("best", f"SELECT _row, postcode FROM (SELECT *, row_number() OVER (PARTITION BY _row ORDER BY d, postcode) "
                 f"AS rn FROM pairs WHERE d <= {POSTCODE_RADIUS_KM}) WHERE rn = 1"),
    ]
    return with_(ctes, "SELECT l.src, l.propertyId, l.latitude, l.longitude, b.postcode "
                       "FROM listings l LEFT JOIN best b ON l._row = b._row")


# ---------------------------------------------------------------------------
# The registry
# ---------------------------------------------------------------------------

def _dirty_as_text() -> str:
    cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in DIRTY_COLUMNS)
    return with_(BASE, f"SELECT {cols} FROM dirty")


def _checkin_mapped() -> list[tuple[str, str]]:
    return MAPPED + checkin_ctes("mapped", ROW_KEY)


def _orphans() -> str:
    keys = {"listing": "listingId", "host": "hostId", "location": "locationId", "amenities": "amenitiesId",
            "review": "reviewId", "checkin": "checkInOutId", "pricing": "pricingId"}
    parts = [f"SELECT {q(d)} AS dimension, (SELECT count(*) FROM t_booking f WHERE NOT EXISTS "
             f"(SELECT 1 FROM t_{d} x WHERE x.{k} = f.{k})) AS orphans" for d, k in keys.items()]
    return with_(TABLES, " UNION ALL ".join(parts))


def _revenue_by_city() -> str:
    s = f"SUM(CASE WHEN f.revenueKnown THEN {cents_sql('f.annualRevenueLtmUSD')} END)"
    n = "count_if(f.revenueKnown)"
    body = (f"SELECT f.src, l.country, l.city, h.superhost, count(*) AS listings, "
            f"count(DISTINCT f.hostId) AS hosts, "
            f"CAST(SUM(CAST(f.annualRevenueLtmUSD AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS total_revenue, "
            f"CASE WHEN {n} > 0 THEN {avg_money_sql(s, n)} END AS avg_revenue "
            f"FROM t_booking f JOIN t_location l ON f.locationId = l.locationId "
            f"LEFT JOIN t_host h ON f.hostId = h.hostId GROUP BY f.src, l.country, l.city, h.superhost")
    return with_(TABLES, body)


def _host_summary() -> str:
    body = ("SELECT h.hostId, h.superhost, h.hostListingCount, f.listings, f.sources, f.total_revenue "
            "FROM t_host h JOIN (SELECT hostId, count(*) AS listings, count(DISTINCT src) AS sources, "
            "CAST(SUM(CAST(annualRevenueLtmUSD AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS total_revenue "
            "FROM t_booking GROUP BY hostId) f ON h.hostId = f.hostId")
    return with_(TABLES, body)


def _hash_ids() -> str:
    def part(c: str, typ: str) -> str:
        text = f"CAST(CAST({c} AS DECIMAL(38,9)) AS VARCHAR)" if typ == "double" else f"CAST({c} AS VARCHAR)"
        return f"coalesce('=' || {text}, '')"

    rest = [(c, t) for c, t in TARGET_TYPES.items() if c != "propertyId"]
    parts = [part(c, t) for c, t in [("src", "string"), ("propertyId", "string"), *rest]]
    digest = f"sha256(concat_ws(chr(31), {', '.join(parts)}))"
    ids = ", ".join(f"_prefix || {q(code)} || {digest} AS {name}" for name, code in ID_CODES.items())
    return with_(CLEANED + [("stripped", f"SELECT {STRIPPED_COLS} FROM cleaned"),
                            ("constant", constants_sql("stripped"))],
                 f"SELECT src, propertyId, {ids} FROM constant")


def _etl_enriched() -> str:
    """Titles by language and memo, postcodes by every pair, for the sources with the flags."""
    km = haversine_sql("l.latitude", "l.longitude", "p.lat", "p.lon")
    ctes = CLEANED + [
        ("stripped", f"SELECT {STRIPPED_COLS} FROM cleaned"),
        ("listings", "SELECT row_number() OVER () AS _row, * FROM stripped"),
        ("points", duckdb_sql(POSTCODE_POINTS_SQL)), ("memo", duckdb_sql(TITLE_MEMO_SQL)),
    ] + language_ctes("listings", ["_row"], "listingTitle") + [
        ("pairs", f"SELECT l._row, p.postcode, {km} AS d FROM listings l CROSS JOIN points p "
                  f"WHERE l.latitude IS NOT NULL AND l.longitude IS NOT NULL"),
        ("near", f"SELECT _row, postcode FROM (SELECT *, row_number() OVER (PARTITION BY _row ORDER BY d, postcode) "
                 f"AS rn FROM pairs WHERE d <= {POSTCODE_RADIUS_KM}) WHERE rn = 1"),
    ]
    title = f"CASE WHEN k.translate AND {NEEDS} THEN coalesce(m.translated, l.listingTitle) ELSE l.listingTitle END"
    code = "CASE WHEN k.geocode THEN coalesce(l.zipcode, n.postcode) ELSE l.zipcode END"
    return with_(ctes, f"SELECT l.src, coalesce(l.propertyId, '0') AS propertyId, "
                       f"replace(coalesce({title}, 'Unknown'), chr(39), '') AS listingTitle, "
                       f"coalesce({code}, '000000') AS zipcode, coalesce(l.latitude, 0) AS latitude, "
                       f"coalesce(l.longitude, 0) AS longitude FROM listings l JOIN sources k ON l.src = k.src "
                       f"LEFT JOIN best b ON l._row = b._row LEFT JOIN memo m ON l.listingTitle = m.source_text "
                       f"LEFT JOIN near n ON l._row = n._row")


def _incremental_etl() -> str:
    """Rows of the first drop are numbered first, the others on from there."""
    first = "numberOfBookingsLtmObservedMonth IN (0, 2, 4, 6, 8, 10)"
    ctes = CLEANED + [
        ("stripped", f"SELECT {STRIPPED_COLS} FROM cleaned"),
        ("constant", constants_sql("stripped")),
        ("numbered", f"SELECT *, row_number() OVER (PARTITION BY src ORDER BY CASE WHEN {first} THEN 0 ELSE 1 END, {ROW_ORDER}) "
                     f"AS _rn FROM constant"),
    ]
    return with_(ctes, "SELECT src, propertyId, _prefix || 'LIS' || CAST(_rn AS VARCHAR) AS listingId, "
                       "_prefix || 'BOK' || CAST(_rn AS VARCHAR) AS bookingId FROM numbered")


def _schema_report() -> str:
    """Each column's kinds of values by source, from one SELECT a column."""
    kinds = [("int", "^\\s*[+-]?[0-9]+\\s*$"), ("decimal", NUMBER_PATTERN),
             ("date", "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"), ("flag", "^[tf]$")]
    cells = " UNION ALL ".join(f"SELECT src, {q(h)} AS column_name, {c} AS value FROM dirty" for c, h in RAW_HEADERS.items())
    kind = " ".join(f"WHEN regexp_matches(value, {q(p)}) THEN {q(k)}" for k, p in kinds)
    counts = ", ".join(f"count(*) FILTER (kind = {q(k)}) AS n_{k}" for k, _ in kinds)
    return with_([("dirty", duckdb_sql(DIRTY_LISTINGS_SQL)), ("cells", cells),
                  ("told", f"SELECT src, column_name, CASE {kind} WHEN trim(value) <> '' THEN 'text' END AS kind FROM cells"),
                  ("counted", f"SELECT src, column_name, count(*) AS n_rows, count(kind) AS n_filled, {counts} FROM told GROUP BY src, column_name")],
                 "SELECT *, CASE WHEN n_filled = 0 THEN 'empty' WHEN n_int = n_filled THEN 'int' WHEN n_int + n_decimal = n_filled THEN 'decimal' "
                 "WHEN n_date = n_filled THEN 'date' WHEN n_flag = n_filled THEN 'flag' ELSE 'text' END AS type FROM counted")


def _row_profile() -> str:
    present = {t for raw, t, _ in COLUMN_MAPPING if raw in HEADER_TO_DIRTY}
    parts = []
    for c in TARGET_TYPES:
        if c in present:
            parts.append(f"SELECT {q(c)} AS column_name, true AS present, count(*) AS n_rows, "
                         f"count_if({c} IS NULL) AS n_null FROM mapped")
        else:
            parts.append(f"SELECT {q(c)} AS column_name, false AS present, count(*) AS n_rows, "
                         f"count(*) AS n_null FROM mapped")
    return with_(MAPPED, " UNION ALL ".join(parts))


def oracles() -> dict[str, str]:
    mode_rows = " UNION ALL ".join(f"SELECT {q(c)} AS column_name, {mode_sql(c)} AS mode" for c in MODE_COLUMNS)
    cons = [("constant", constants_sql("mapped"))]
    cons_keep = [("constant", constants_sql("mapped", keep=True))]
    ids = ", ".join(ID_CODES)
    per_source = with_(MAPPED, "SELECT src, count(*) AS rows, count(zipcode) AS zipcodes, "
                               "CAST(SUM(CAST(annualRevenueLtmUSD AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS revenue FROM mapped GROUP BY src")
    return {
        "csv_scan": _dirty_as_text(),
        "source_union": per_source,
        "source_headers": per_source,
        "landing_by_source": with_(BASE, "SELECT src, " + ", ".join(f'{c} AS "{h}"' for c, h in RAW_HEADERS.items())
                                   + " FROM dirty"),
        "sink_roundtrip": with_(BASE, "SELECT * FROM dirty"),
        "incremental_ingest": _dirty_as_text(),
        "column_mapping": with_(BASE + [("m", mapped_sql(ensure=False))], "SELECT * FROM m"),
        "ensure_columns": with_(BASE + [("m", mapped_sql(tuple(DROPPED_HEADERS)))], "SELECT * FROM m"),
        "source_constants": with_(MAPPED + cons,
                                  "SELECT src, propertyId, country, state, city, currencyNative FROM constant"),
        "source_constants_keep": with_(MAPPED + cons_keep,
                                       "SELECT src, propertyId, country, state, city, currencyNative FROM constant"),
        "drop_common_missing": with_(MAPPED, f"SELECT src, propertyId, {', '.join(COMMON_MISSING)} "
                                             f"FROM mapped WHERE {NOT_EMPTY}"),
        "dedupe_rows": with_(CLEANED, "SELECT * FROM cleaned"),
        "strip_symbols": with_(MAPPED, f"SELECT src, propertyId, {strip_sql('listingTitle')} AS listingTitle "
                                       f"FROM mapped"),
        "strip_symbols_all": with_(MAPPED, f"SELECT {STRIPPED_COLS} FROM mapped"),
        "strip_quotes": with_(MAPPED, "SELECT src, propertyId, replace(listingTitle, chr(39), '') AS listingTitle "
                                      "FROM mapped"),
        "flags_to_bool": with_(MAPPED, "SELECT src, propertyId, " + ", ".join(
            f"{flag_sql(c)} AS {c}" for c in ["instantBookable", "petsAllowed", "exactLocation",
                                               "instantBookEnabled"]) + " FROM mapped"),
        "flags_host": with_(MAPPED, f"SELECT src, propertyId, hostId, {flag_sql('superhost')} AS superhost "
                                    f"FROM mapped"),
        "checkin_split": with_(MAPPED + checkin_ctes("mapped", ROW_KEY),
                               "SELECT src, propertyId, checkinStartTime, checkinEndTime FROM ck_split"),
        "clock_24h": with_(_checkin_mapped(), "SELECT src, propertyId, " + ", ".join(
            f"{clock_sql(c)} AS {c}" for c in MODE_COLUMNS) + " FROM ck_split"),
        "amenities_array": with_(MAPPED, f"SELECT src, propertyId, {amenity_list_sql('amenities')} AS amenities "
                                         f"FROM mapped"),
        "amenities_bridge": with_(TABLES, f"SELECT amenitiesId, unnest({amenity_list_sql('amenities')}) AS amenity "
                                          f"FROM t_amenities"),
        "mode_values": with_(_checkin_mapped(), mode_rows),
        "mode_impute": with_(_checkin_mapped(), checkin_filled(ROW_KEY)),
        "fill_listing": _fill_oracle("listing"),
        "fill_location": _fill_oracle("location"),
        "fill_host": _fill_oracle("host"),
        "fill_review": _fill_oracle("review"),
        "fill_pricing": _fill_oracle("pricing"),
        "fill_fact": _fill_oracle("booking"),
        "surrogate_ids": with_(WIDE, f"SELECT src, propertyId, {ids} FROM wide"),
        "hash_ids": _hash_ids(),
        "dim_listing": with_(TABLES, "SELECT * FROM t_listing"),
        "dim_host": with_(TABLES, "SELECT * FROM t_host"),
        "dim_location": with_(TABLES, "SELECT * FROM t_location"),
        "dim_amenities": with_(TABLES, "SELECT * FROM t_amenities"),
        "dim_review": with_(TABLES, "SELECT * FROM t_review"),
        "dim_checkin": with_(TABLES, "SELECT * FROM t_checkin"),
        "dim_pricing": with_(TABLES, "SELECT * FROM t_pricing"),
        "fact_booking": with_(TABLES, "SELECT * FROM t_booking"),
        "star_orphans": _orphans(),
        "star_revenue_by_city": _revenue_by_city(),
        "star_revenue_laid_out": _revenue_by_city(),
        "star_host_summary": _host_summary(),
        "row_profile": _row_profile(),
        "plain_text_gate": _gate_rows("documents", ["text", "lang", "source"]) + " UNION ALL "
                           + _gate_rows("conversations", ["role", "text"]),
        "detect_language": with_([("texts", duckdb_sql(DOCUMENTS_SQL))] + language_ctes("texts", ["doc_id"]),
                                 "SELECT d.doc_id, d.lang, b.lang AS lang_detected "
                                 "FROM texts d LEFT JOIN best b ON d.doc_id = b.doc_id"),
        "translate_memo": with_(_translate_ctes(), f"SELECT c.conv_id, c.turn, {TRANSLATED} AS text_en "
                                                   f"{TRANSLATE_FROM}"),
        "translate_unseen": with_(_translate_ctes(),
                                  f"SELECT c.text, count(*) AS n_rows FROM talk c "
                                  f"LEFT JOIN best b ON c.conv_id = b.conv_id AND c.turn = b.turn "
                                  f"WHERE {NEEDS} AND c.text NOT IN (SELECT source_text FROM memo) "
                                  f"GROUP BY c.text"),
        "translate_gated": _translate_gated(),
        "nearest_postcode": _nearest(),
        "geocode_payload": with_(
            [("payloads", duckdb_sql(GEOCODER_PAYLOADS_SQL))],
            "SELECT property_id, CASE WHEN json_valid(payload) THEN list_filter(flatten(list_transform("
            "from_json(json_extract(payload, '$.results'), "
            "'[{\"address_components\":[{\"long_name\":\"VARCHAR\",\"types\":[\"VARCHAR\"]}]}]'), "
            "lambda r: r.address_components)), lambda x: list_contains(x.types, 'postal_code'))[1].long_name END "
            "AS postcode FROM payloads"),
        "etl_enriched": _etl_enriched(),
        "incremental_etl": _incremental_etl(),
        "schema_report": _schema_report(),
        "etl_counts": with_(CLEANED, "SELECT 'raw_rows' AS step, count(*) AS rows FROM dirty UNION ALL "
                                     "SELECT 'clean_rows', count(*) FROM cleaned"),
        "catalog_tables": with_(TABLES, " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS rows FROM t_{t}" for t in
            ["listing", "host", "location", "amenities", "review", "checkin", "pricing", "booking"])),
        "unparsed_times": with_(_checkin_mapped(), " UNION ALL ".join(
            f"SELECT {q(c)} AS column_name, count(*) FILTER ({c} IS NOT NULL AND {clock_sql(c)} IS NULL) AS unparsed "
            f"FROM ck_split" for c in MODE_COLUMNS)),
        "monotonic_ids": with_(BASE, "SELECT src, count(*) AS rows, count(*) AS ids, count(*) AS prefixed FROM dirty GROUP BY src"),
        "fact_repartition": with_(CLEANED, "SELECT 7 AS partitions, count(*) AS rows FROM cleaned"),
        "enrich_hook": "SELECT DISTINCT text AS value, lower(text) AS result, 'ok' AS status "
                       "FROM conversations WHERE text IS NOT NULL",
    }
