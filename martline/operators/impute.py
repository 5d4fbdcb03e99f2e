"""Missing values: constant defaults and most-frequent-value (mode) fills."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """``coalesce(c, default)`` for each listed column present in ``df``.

    The default is cast to the column's type, as a dictionary ``na.fill``
    would do (0 on a text column gives ``"0"``).  One projection.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c in defaults:
            out.append(F.coalesce(F.col(c), F.lit(defaults[c]).cast(types[c])).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, value, n``: how often each non-null value occurs, for all columns in one shuffle.

    The columns are unpivoted to (column, value) and counted per pair (partial
    counts map-side, so a hot value costs nothing extra).  Counts of several
    tables add up (``merged_counts``), so modes can be kept without old rows.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    long = df.select(F.expr(f"stack({len(columns)}, {pairs}) AS (column, value)"))
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def merged_counts(parts: list[DataFrame]) -> DataFrame:
    """The counts of all parts together."""
    return reduce(DataFrame.unionByName, parts).groupBy("column", "value").agg(F.sum("n").alias("n"))


def modes_of(counts: DataFrame, columns: list[str]) -> DataFrame:
    """One row, one column per counted column: its most frequent value, ties to the smallest; NULL without values."""
    modes = counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))).alias("mode"))
    return modes.groupBy().pivot("column", columns).agg(F.first("mode"))


def mode_row(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row, one column per input column: its most frequent non-null value.

    Ties go to the smallest value.  An all-NULL column gives NULL.
    """
    return modes_of(value_counts(df, columns), columns)


def mode_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (``column``, ``mode``), one per input column."""
    row = mode_row(df, columns)
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return row.select(F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, mode)"))


def mode_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill NULLs of ``columns`` with their modes (an all-NULL column stays NULL).

    The modes come in as one scalar subquery (a struct of all modes) on a
    one-row frame: no join, no round trip through the driver.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    row = mode_row(df, columns)
    # One scalar subquery carries all modes, so they are computed once.
    modes = row.select(F.struct(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in columns])).scalar()
    with_modes = df.select("*", modes.alias("_modes"))
    out = []
    for c in df.columns:
        if c in columns:
            out.append(F.coalesce(F.col(c), F.col("_modes")[c]).alias(c))
        else:
            out.append(F.col(c))
    return with_modes.select(*out)
