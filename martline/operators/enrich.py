"""Enrichment: language, translation memo, nearest postcode, external-call hook.

The reference called web services row by row.  Here the services are
re-aimed as data: scripts and letter profiles for language, a memo table of
earlier translations joined by the text's digest, a postcode point table joined by grid
cell, and one Arrow-batched hook for whatever must still call out.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SCRIPT_LANGUAGES, TARGET_LANGUAGE
from ..functions.geo import Grid, haversine_km
from ..functions.language import Profiles, bound, default_profiles, latin_language
from ..functions.json import postal_code
from ..functions.text import is_plain_text
from ..session import checked_broadcast, default_parallelism, fits_broadcast, scratch_path, shuffles_removed
from ..sources.files import exists
from .quality import plain_text_gate


# ---------------------------------------------------------------------------
# Language
# ---------------------------------------------------------------------------

def language_of(text: Column | str, profiles: Profiles) -> Column:
    """Language of the whole text: by script, else by its groups of letters.

    If letters of one of ``SCRIPT_LANGUAGES`` outnumber the Latin ones, the
    script with most letters names the language (ties: the smallest code;
    any Japanese syllable makes Han text Japanese).  Otherwise it is the
    language whose profile (``functions.language``) fits best, if it leads the
    next one by a margin; a text without letters, or in doubt, gives NULL.
    Row by row inside the JVM, so a 20,000-word text is one row, not 20,000
    shuffled ones; scripts are counted only in texts that have letters beyond Latin.
    """
    col = F.col(text) if isinstance(text, str) else text
    known = "".join(rf"\p{{Is{s}}}" for s in SCRIPT_LANGUAGES)
    scripts: dict[str, list[str]] = {}
    for script, lang in SCRIPT_LANGUAGES.items():
        scripts.setdefault(lang, []).append(script)

    def letters(of: Column, names: list[str]) -> Column:
        """How many letters are of these scripts: what a text loses without them."""
        return F.char_length(of) - F.char_length(F.regexp_replace(of, "[" + "".join(rf"\p{{Is{s}}}" for s in names) + "]+", ""))

    def top(of: Column, kana: Column) -> Column:
        counts = [(F.when(kana > 0, letters(of, [*scripts["ja"], "Han"])).otherwise(F.lit(0)) if lang == "ja"
                   else F.when(kana > 0, F.lit(0)).otherwise(letters(of, names)) if lang == "zh" else letters(of, names), lang)
                  for lang, names in sorted(scripts.items())]
        found = F.array(*[F.struct((-n).alias("n"), F.lit(lang).alias("lang")) for n, lang in counts])
        return F.array_min(F.filter(found, lambda s: s["n"] < 0))

    # No script of these is ASCII, so its letters are passed over before any script is looked up.
    foreign = col.rlike(rf"[\x{{80}}-\x{{10FFFF}}&&[{known}]]")
    others = F.regexp_replace(col, rf"[\x{{0}}-\x{{7F}}[^{known}]]+", "")
    most = bound(others, lambda of: bound(letters(of, scripts["ja"]), lambda kana: top(of, kana)))
    by_script = bound(most, lambda best: F.when(-best["n"] > letters(col, ["Latin"]), best["lang"]))
    return F.coalesce(F.when(foreign, by_script), latin_language(col, profiles))


def detect_language(df: DataFrame, text: str, out: str = "lang_detected", profiles: Profiles | None = None) -> DataFrame:
    """``df`` with the language of ``text``; profiles of one's own come from ``functions.language.learn_profiles``."""
    return df.withColumn(out, language_of(text, profiles or default_profiles(df.sparkSession)))


# ---------------------------------------------------------------------------
# Translation through a memo of earlier answers
# ---------------------------------------------------------------------------

def _needs_translation(df: DataFrame, text: str) -> Column:
    """A text is translated only when its language is known and not the target.

    The language occurs once in the expression, so it is computed once.
    """
    return F.coalesce(language_of(text, default_profiles(df.sparkSession)) != F.lit(TARGET_LANGUAGE), F.lit(False))


def _memo_by_digest(memo: DataFrame) -> DataFrame:
    """One translation per text (the smallest if the memo holds several), keyed by the text's digest."""
    return memo.groupBy(F.sha2("source_text", 256).alias("_m_key")).agg(
        F.min("source_text").alias("_m_text"), F.min("translated").alias("_m_tr"))


def _or_passed_by(df: DataFrame, only: Column, out: str, value: Column, looked_up: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``looked_up`` of the rows for which ``only`` is true; the others pass by the join with ``value`` as ``out``.

    For joins that shuffle: rows that would meet nothing are not moved, for a second read of ``df``.
    """
    return looked_up(df.where(only)).unionByName(df.where(~only).withColumn(out, value))


def _translated(df: DataFrame, text: str, by_digest: DataFrame, out: str, only: Column | None = None) -> DataFrame:
    # Rows that need no translation get a key that meets nothing and spreads evenly.
    needs = _needs_translation(df, text) if only is None else only & _needs_translation(df, text)
    key = F.when(needs, F.sha2(text, 256)).otherwise(
        F.concat(F.lit("-"), F.xxhash64(text).cast("string")))
    joined = df.withColumn("_t_key", key).join(by_digest, F.col("_t_key") == F.col("_m_key"), "left")
    value = F.when(F.col("_m_text") == F.col(text), F.coalesce("_m_tr", text)).otherwise(F.col(text))
    cols = [value.alias(out) if c == out else F.col(f"`{c}`") for c in df.columns]
    if out not in df.columns:
        cols.append(value.alias(out))
    return joined.select(*cols)


def translate_memo(df: DataFrame, text: str, memo: DataFrame, out: str | None = None,
                   max_broadcast_rows: int = 1_000_000, only: Column | None = None) -> DataFrame:
    """Replace ``text`` by its memo translation when it is not in the target language.

    ``memo`` has ``source_text, translated``; several rows for one text
    collapse to the smallest translation, so rows never multiply.  Texts
    without a memo entry, in the target language or of unknown language keep
    their value.  The join is on the text's SHA-256 (then checked on the
    text); the memo is broadcast after a check of its rows and bytes, else
    joined by a shuffle (AQE splits a hot text).  ``only`` limits it to rows
    for which it is true (it must not be NULL); the others are not shuffled.
    """
    by_digest, out = _memo_by_digest(memo), out or text
    if fits_broadcast(by_digest, max_broadcast_rows):
        return _translated(df, text, F.broadcast(by_digest), out, only)
    if only is None:
        return _translated(df, text, by_digest, out)
    return _or_passed_by(df, only, out, F.col(text), lambda rows: _translated(rows, text, by_digest, out))


def translate_unseen(df: DataFrame, text: str, memo: DataFrame) -> DataFrame:
    """Distinct texts that need translation and are not in the memo: the only
    work left for an external service.  Copies are counted map-side first."""
    need = df.where(_needs_translation(df, text)).groupBy(F.col(text).alias("text")) \
             .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("_key", F.sha2("text", 256))
    known = memo.select(F.sha2("source_text", 256).alias("_key")).distinct()
    return need.join(known, "_key", "left_anti").drop("_key")


def translate_gated(df: DataFrame, memo: DataFrame, columns: list[str] | None = None,
                    max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Translate every text column that fails the plain-text gate.

    The gate is one aggregation over all columns; its result (one small row
    per column) decides on the driver which columns get the memo join.  The
    memo is reduced and its size checked once for all columns.
    """
    gate = plain_text_gate(df, columns).where("n_failing > 0").collect()
    if not gate:
        return df
    by_digest = checked_broadcast(_memo_by_digest(memo), max_broadcast_rows)
    for row in gate:
        df = _translated(df, row["column_name"], by_digest, row["column_name"])
    return df


def learn_translations(spark_df: DataFrame, text: str, memo_path: str, fn: Callable[[pd.Series], pd.Series],
                       max_calls_per_second: float | None = None) -> DataFrame:
    """The memo after one round of the service: texts unseen so far are translated once and appended.

    The hook's answers are written before they are used, so no action calls
    the service again; only calls that succeeded enter the memo.  Returns the memo.
    """
    spark = spark_df.sparkSession
    memo = _memo(spark, memo_path, MEMO_SCHEMA)
    unseen = translate_unseen(spark_df, text, memo)
    answers = scratch_path(spark, "translations")
    enrich_hook(unseen, "text", fn, max_calls_per_second).write.parquet(answers)
    done = spark.read.schema(HOOK_SCHEMA).parquet(answers).where("status = 'ok' AND result IS NOT NULL")
    done.select(F.col("value").alias("source_text"), F.col("result").alias("translated")).write.mode("append").parquet(memo_path)
    return spark.read.schema(MEMO_SCHEMA).parquet(memo_path)


def plain_text(df: DataFrame, text: str, out: str = "plain") -> DataFrame:
    return df.withColumn(out, is_plain_text(text))


# ---------------------------------------------------------------------------
# Nearest postcode within a radius
# ---------------------------------------------------------------------------

# Points in a grid cell that are compared without a finer grid, and the finest grid: radius / 4**MOST_LEVELS.
CELL_POINTS, MOST_LEVELS = 32, 6
# Decimals of a degree by which coordinates share an answer of the geocoder (about 100 m).
CELL_DECIMALS = 3


def nearest_postcode(df: DataFrame, points: DataFrame, radius_km: float, lat: str = "latitude",
                     lon: str = "longitude", out: str = "postcode",
                     max_broadcast_rows: int = 1_000_000, only: Column | None = None) -> DataFrame:
    """Postcode of the nearest reference point within ``radius_km``, else NULL.

    ``points`` has ``postcode, lat, lon``.  Distinct coordinates are looked up,
    on a grid fine enough that a cell holds few points, then on grids four
    times coarser until the radius is reached; a coordinate with a point
    within a grid's own radius is done, since nothing nearer lies outside
    the cells around it.  Ties go to the smallest postcode.  Rows without
    coordinates take no part and get NULL.  Candidates are joined as rows on
    their cell and reduced by a minimum, so no cell becomes an array; the
    points are broadcast within ``max_broadcast_rows`` and a bound of bytes.
    Rows for which ``only`` (never NULL) is false are not looked up, get
    NULL and are not shuffled.  ``df`` is read once for its coordinates and once for its rows,
    with ``only`` and more answers than are broadcast twice for its rows.
    """
    spark = df.sparkSession
    places = points.where("lat IS NOT NULL AND lon IS NOT NULL").groupBy(
        F.col("lat").alias("_plat"), F.col("lon").alias("_plon")).agg(F.min("postcode").alias("_pc"))
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    if only is not None:
        known = known & only
    left = df.where(known).select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    found = None
    for radius in reversed(_grid_radii(places, float(radius_km))):
        path = scratch_path(spark, "nearest")
        with shuffles_removed(spark):
            _nearest_in_cells(left, places, radius, max_broadcast_rows).write.parquet(path)
        level = spark.read.parquet(path)
        done = level.where("_pc IS NOT NULL")
        found = done if found is None else found.unionByName(done)
        left = level.where("_pc IS NULL").select("_lat", "_lon")
        if left.isEmpty():
            break
    found = found.select(_place("_lat", "_lon").alias("_f_key"), "_lat", "_lon", "_pc")

    def looked_up(rows: DataFrame, answers: DataFrame) -> DataFrame:
        # Rows that are not looked up have a key that meets nothing and spreads evenly; a hot coordinate is
        # one row on the other side, so it is broadcast or its rows are split by AQE.
        key = F.when(known, _place(lat, lon)).otherwise(F.xxhash64(*[f"`{c}`" for c in df.columns]))
        joined = rows.select("*", key.alias("_key"), known.alias("_known")).join(
            answers, (F.col("_key") == F.col("_f_key")) & F.col("_known") & (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon")), "left")
        return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_pc").alias(out))

    if fits_broadcast(found, max_broadcast_rows):
        return looked_up(df, F.broadcast(found))
    if only is None:
        return looked_up(df, found)
    return _or_passed_by(df, only, out, F.lit(None).cast(found.schema["_pc"].dataType), lambda rows: looked_up(rows, found))


def grid_cell(lat: str, lon: str, decimals: int = CELL_DECIMALS) -> Column:
    """A coordinate rounded to a cell, as text ``lat,lon``; NULL without both."""
    def rounded(c: str) -> Column:
        return F.round(F.col(c), decimals).try_cast(f"decimal({decimals + 6},{decimals})").cast("string")

    return F.concat(rounded(lat), F.lit(","), rounded(lon))


def learn_postcodes(df: DataFrame, memo_path: str, fn: Callable[[pd.Series], pd.Series], lat: str = "latitude",
                    lon: str = "longitude", max_calls_per_second: float | None = None) -> DataFrame:
    """The memo ``cell, postcode`` after one round of the geocoder: cells unseen so far are asked once and appended.

    ``fn`` gets cells (``lat,lon``) and answers with the service's JSON, whose
    postal code is kept; an answer without one is kept as NULL and not asked
    again, a failed call is.  The memo's folder may be empty or absent.
    """
    spark = df.sparkSession
    memo = _memo(spark, memo_path, POSTCODE_SCHEMA)
    cells = df.select(grid_cell(lat, lon).alias("cell")).where("cell IS NOT NULL").distinct().join(memo, "cell", "left_anti")
    answers = scratch_path(spark, "postcodes")
    enrich_hook(cells, "cell", fn, max_calls_per_second).write.parquet(answers)
    done = spark.read.schema(HOOK_SCHEMA).parquet(answers).where("status = 'ok'")
    done.select(F.col("value").alias("cell"), postal_code("result").alias("postcode")).write.mode("append").parquet(memo_path)
    return spark.read.schema(POSTCODE_SCHEMA).parquet(memo_path)


def memo_postcode(df: DataFrame, memo: DataFrame, only: Column, out: str, lat: str = "latitude", lon: str = "longitude",
                  max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """``df`` with the memo's postcode of each row's cell where ``only`` (never NULL) is true, else NULL; other rows are not shuffled."""
    known = memo.groupBy(F.col("cell").alias("_m_cell")).agg(F.min("postcode").alias("_m_code"))

    def looked_up(rows: DataFrame, answers: DataFrame) -> DataFrame:
        # Rows that are not looked up have a key that meets nothing and spreads evenly.
        key = F.coalesce(F.when(only, grid_cell(lat, lon)), F.concat(F.lit("-"), F.xxhash64(*[f"`{c}`" for c in df.columns]).cast("string")))
        joined = rows.withColumn("_cell", key).join(answers, F.col("_cell") == F.col("_m_cell"), "left")
        return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_m_code").alias(out))

    if fits_broadcast(known, max_broadcast_rows):
        return looked_up(df, F.broadcast(known))
    return _or_passed_by(df, only, out, F.lit(None).cast(known.schema["_m_code"].dataType), lambda rows: looked_up(rows, known))


def _memo(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The memo in a folder, empty if there is none yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _place(lat: str, lon: str) -> Column:
    """A coordinate's hash; adding zero makes -0.0 and 0.0 alike, as grouping does."""
    return F.xxhash64(F.col(lat) + F.lit(0.0), F.col(lon) + F.lit(0.0))


def _grid_radii(places: DataFrame, radius: float) -> list[float]:
    """The radius and ever finer ones, until no cell holds many points."""
    radii = [radius]
    while len(radii) <= MOST_LEVELS:
        g = Grid(radii[-1])
        band = g.band(F.col("_plat"))
        cells = places.groupBy(band, g.cell(F.col("_plon"), g.cells_in_band(band))).agg(F.count(F.lit(1)).alias("n"))
        if (cells.agg(F.max("n")).first()[0] or 0) <= CELL_POINTS:
            break
        radii.append(radii[-1] / 4)
    return radii


def _nearest_in_cells(left: DataFrame, places: DataFrame, radius: float, max_broadcast_rows: int) -> DataFrame:
    """``_lat, _lon, _pc``: the nearest point within ``radius`` of each coordinate, or NULL."""
    g = Grid(radius)
    b0 = g.band(F.col("_plat"))
    p = places.select("*", F.explode(F.array(b0 - 1, b0, b0 + 1)).alias("_band")) \
              .where((F.col("_band") >= 0) & (F.col("_band") < g.n_bands))
    n = g.cells_in_band(F.col("_band"))
    c0 = g.cell(F.col("_plon"), n)
    p = p.select("*", F.explode(F.array_distinct(F.transform(F.array(c0 - 1, c0, c0 + 1), lambda c: F.pmod(c, n)))).alias("_cell"))
    p = checked_broadcast(p.select("_pc", "_plat", "_plon", "_band", "_cell"), max_broadcast_rows)
    keyed = left.select("*", g.band(F.col("_lat")).alias("_band"))
    keyed = keyed.select("*", g.cell(F.col("_lon"), g.cells_in_band(F.col("_band"))).alias("_cell"))
    km = haversine_km(F.col("_lat"), F.col("_lon"), F.col("_plat"), F.col("_plon"))
    near = F.when(km <= F.lit(radius), F.struct(km.alias("d"), F.col("_pc").alias("pc")))
    return (keyed.join(p, ["_band", "_cell"], "left").groupBy("_lat", "_lon")
            .agg(F.min(near).alias("_best")).select("_lat", "_lon", F.col("_best.pc").alias("_pc")))


# ---------------------------------------------------------------------------
# External calls, batched
# ---------------------------------------------------------------------------

HOOK_SCHEMA = "value string, result string, status string"
MEMO_SCHEMA = "source_text string, translated string"
POSTCODE_SCHEMA = "cell string, postcode string"

# Values handed to the service at a time: this much of a task's budget, in seconds.
SLICE_SECONDS = 0.2


def _call_batches(fn: Callable[[pd.Series], pd.Series], per_task_rate: float | None
                  ) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free = [time.monotonic()]  # when the budget allows the next call

        def call(values: pd.Series) -> pd.Series:
            """One paced call: its values are paid for before the next one starts."""
            if per_task_rate:
                time.sleep(max(0.0, free[0] - time.monotonic()))
                free[0] = max(free[0], time.monotonic()) + len(values) / per_task_rate
            return fn(values)

        def answers(values: list[str]) -> list[tuple[str | None, str]]:
            """Halves a failing slice until the failing values stand alone; values that got an answer are not sent again."""
            try:
                return [(r if pd.notna(r) else None, "ok") for r in call(pd.Series(values, dtype=object))]
            except Exception as e:  # noqa: BLE001 - reported in the status column
                if len(values) == 1:
                    return [(None, f"error: {type(e).__name__}")]
                half = len(values) // 2
                return answers(values[:half]) + answers(values[half:])

        for pdf in batches:
            values = pdf["value"].tolist()
            size = max(1, int(per_task_rate * SLICE_SECONDS)) if per_task_rate else len(values) or 1
            found = [x for at in range(0, len(values), size) for x in answers(values[at:at + size])]
            yield pd.DataFrame({"value": values, "result": [r for r, _ in found], "status": [s for _, s in found]}, dtype=object)
    return run


def enrich_hook(df: DataFrame, column: str, fn: Callable[[pd.Series], pd.Series],
                max_calls_per_second: float | None = None, partitions: int | None = None
                ) -> DataFrame:
    """Call ``fn`` once per distinct value of ``column``, in Arrow batches.

    ``fn`` maps a pandas Series of text to a Series of text (a client for a
    translation or geocoding service, say).  Output: ``value, result,
    status``; a failing call gives ``result`` NULL and ``status`` "error: ...".
    ``max_calls_per_second`` is a budget of values for the whole job: it is split over
    ``partitions`` tasks that may run at once, and each task hands over a
    fraction of a second's budget at a time and waits before the next.  The
    result is lazy: write it before using it twice (``learn_translations``).
    """
    values = df.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct()
    per_task = None
    if max_calls_per_second:
        parts = partitions or default_parallelism(df.sparkSession)
        values = values.repartition(parts)
        per_task = max_calls_per_second / parts
    elif partitions:
        values = values.repartition(partitions)
    return values.mapInPandas(_call_batches(fn, per_task), HOOK_SCHEMA)
