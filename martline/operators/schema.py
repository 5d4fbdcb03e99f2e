"""Mapping raw headers to typed columns, filling in absent columns, source constants."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COLUMN_MAPPING, DATE_FORMAT, SOURCE_COL, TARGET_TYPES
from ..session import checked_broadcast, split_compiled

log = logging.getLogger(__name__)

NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def cast_text(c: Column, typ: str, date_format: str = DATE_FORMAT) -> Column:
    """Cast raw text to ``typ``; text that does not fit becomes NULL.

    Integers go through double and are truncated, so ``"1.5"`` -> 1 and
    ``" 7 "`` -> 7.  A number is decimal digits with an optional sign, point
    and exponent: ``7d``, ``NaN`` and ``Infinity`` are text.  Dates must match
    ``date_format`` exactly.
    """
    if typ == "string":
        return c
    number = F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))
    if typ == "int":
        return number.try_cast("int")
    if typ == "double":
        return number
    if typ == "date":
        return F.try_to_date(c, date_format)
    raise ValueError(f"unsupported target type {typ!r}")


def apply_mapping(df: DataFrame, mapping: list[tuple[str, str, str]] = COLUMN_MAPPING,
                  keep: tuple[str, ...] = (SOURCE_COL,)) -> DataFrame:
    """Rename and cast mapped raw columns; drop every unmapped column.

    Columns in ``keep`` (the lineage column) pass through unchanged.  Mapped
    headers that a source lacks are simply absent from the result.
    """
    present = set(df.columns)
    cols = [split_compiled(F.col(k)).alias(k) for k in keep if k in present]
    cols += [cast_text(F.col(f"`{raw}`"), typ).alias(target)
             for raw, target, typ in mapping if raw in present]
    return df.select(*cols)


def ensure_columns(df: DataFrame, types: dict[str, str] = TARGET_TYPES,
                   keep: tuple[str, ...] = (SOURCE_COL,)) -> DataFrame:
    """Add each absent target column as a typed NULL; order columns as declared."""
    present = set(df.columns)
    missing = [c for c in types if c not in present]
    if missing:
        log.warning("adding absent columns as NULL: %s", ", ".join(missing))
    cols = [F.col(k) for k in keep if k in present]
    cols += [F.col(c) if c in present else F.lit(None).cast(t).alias(c) for c, t in types.items()]
    return df.select(*cols)


def missing_columns(df: DataFrame, types: dict[str, str] = TARGET_TYPES) -> list[str]:
    """Target columns absent from ``df`` (schema only, no job)."""
    present = set(df.columns)
    return [c for c in types if c not in present]


def source_count(sources: DataFrame, key: str = SOURCE_COL) -> int:
    """Rows of a per-source table; one small job.  A source listed twice would
    multiply its listings in the join, so it is an error."""
    row = sources.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("d")).first()
    if row["n"] != row["d"]:
        raise ValueError(f"a source appears more than once in the source table ({key})")
    return row["n"]


def unregistered(src: Column) -> Column:
    """Raises for a row of an unknown source."""
    return F.raise_error(F.concat(F.lit("source not in the source table: "), F.coalesce(src.cast("string"), F.lit("NULL")))
                         ).cast("string")


CONSTANT_COLUMNS = {"country": "country", "state": "state", "city": "city",
                    "currencyNative": "currency"}


def source_constants(df: DataFrame, sources: DataFrame, unset: str = "null",
                     max_broadcast_rows: int = 100_000) -> DataFrame:
    """Overwrite country, state, city and currency with per-source constants.

    ``sources`` holds one row per source: ``src, country, state, city,
    currency`` (NULL = not given).  ``unset="null"`` writes NULL where a
    constant is not given; ``unset="keep"`` keeps the row's own value there.
    The source table is joined by ``src``; it is broadcast when its row count
    is within ``max_broadcast_rows``.  A row whose source is not in the table
    raises when it is computed: its constants would otherwise be erased.
    """
    if unset not in ("null", "keep"):
        raise ValueError("unset must be 'null' or 'keep'")
    consts = sources.select(F.col(SOURCE_COL).alias("_src"),
                            *[F.col(s).alias(f"_c_{t}") for t, s in CONSTANT_COLUMNS.items()])
    n = source_count(consts, "_src")
    joined = df.join(checked_broadcast(consts, max_broadcast_rows, known_rows=n),
                     F.col(SOURCE_COL) == F.col("_src"), "left")
    out = []
    for c in df.columns:
        if c in CONSTANT_COLUMNS:
            const = F.when(F.col("_src").isNull(), unregistered(F.col(SOURCE_COL))).otherwise(
                F.col(f"_c_{c}")).cast(df.schema[c].dataType)
            out.append((const if unset == "null" else F.coalesce(const, F.col(c))).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)
