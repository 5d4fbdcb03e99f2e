"""Row quality: empty rows, duplicates, symbol stripping, plain-text gate, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..config import COMMON_MISSING, PLAIN_TEXT_PATTERN, SOURCE_COL
from ..functions.text import strip_symbols


def drop_common_missing(df: DataFrame, subset: list[str] = COMMON_MISSING) -> DataFrame:
    """Drop rows where every column of ``subset`` is NULL."""
    return df.na.drop(how="all", subset=subset)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Remove exact duplicate rows (all columns, NULLs compare equal).

    A hash aggregate on all columns; copies collapse map-side before the
    shuffle, so a row repeated a billion times costs one row per task.
    """
    return df.dropDuplicates()


def strip_symbols_all(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Apply ``strip_symbols`` to every text column (other types keep their type)."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[strip_symbols(F.col(f"`{c}`")).alias(c) if c in targets else F.col(f"`{c}`")
                       for c in df.columns])


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def plain_text_gate(df: DataFrame, columns: list[str] | None = None,
                    pattern: str = PLAIN_TEXT_PATTERN) -> DataFrame:
    """Per column, the number of non-null values that are not plain text.

    One pass over ``df`` for all columns; the result has one row per column
    (``column``, ``n_failing``).  A column "needs translation" when
    ``n_failing > 0``.
    """
    cols = columns if columns is not None else text_columns(df)
    counts = df.agg(*[F.count_if(~F.col(f"`{c}`").rlike(pattern)).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.select(F.expr(f"stack({len(cols)}, {pairs}) AS (column_name, n_failing)"))


def row_profile(df: DataFrame, expected: list[str]) -> DataFrame:
    """Missing-column report with row and NULL counts, in one pass.

    One row per expected column: ``column``, ``present`` (in the input
    schema), ``n_rows``, ``n_null`` (absent columns count as all NULL).
    """
    present = set(df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in expected if c in present]
    counts = df.agg(*aggs)
    rows = []
    for c in expected:
        n_null = F.col(f"`{c}`") if c in present else F.col("__rows")
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(c in present).alias("present"),
                             F.col("__rows").alias("n_rows"), n_null.alias("n_null")))
    return counts.select(F.inline(F.array(*rows)))


#: Kinds of text values, from narrow to wide; a value is of the first one that it fits.
VALUE_KINDS = {
    "int": r"^\s*[+-]?[0-9]+\s*$",
    "decimal": r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$",
    "date": r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$",
    "flag": r"^[tf]$",
}


def schema_report(df: DataFrame, by: str = SOURCE_COL) -> DataFrame:
    """Type of every text column, per source: ``<by>, column_name, n_rows, n_filled, n_int, n_decimal, n_date, n_flag, type``.

    ``type`` is the narrowest that all filled values fit: ``empty`` (none, or
    blanks only), ``int``, ``decimal`` (whole numbers too), ``date``, ``flag``
    or ``text``.  The counts of two tables add up to those of both, so reports
    can be kept and merged (``merged_report``).  One aggregation for all
    columns; values are unpivoted map-side and only counts are shuffled.
    """
    columns = [c for c in text_columns(df) if c != by]
    pairs = ", ".join("'{}', `{}`".format(c.replace("\\", "\\\\").replace("'", "\\'"), c.replace("`", "``")) for c in columns)
    long = df.select(by, F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, value)"))
    kind = F.when(F.trim("value") != "", F.lit("text"))
    for name, pattern in reversed(VALUE_KINDS.items()):
        kind = F.when(F.col("value").rlike(pattern), F.lit(name)).otherwise(kind)
    counted = long.select(by, "column_name", kind.alias("kind")).groupBy(by, "column_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("kind").alias("n_filled"),
        *[F.count_if(F.coalesce(F.col("kind") == name, F.lit(False))).alias(f"n_{name}") for name in VALUE_KINDS])
    return counted.withColumn("type", _type_of())


def _type_of() -> Column:
    """The type that a column's counts tell."""
    filled = F.col("n_filled")
    return (F.when(filled == 0, "empty").when(F.col("n_int") == filled, "int")
            .when(F.col("n_int") + F.col("n_decimal") == filled, "decimal").when(F.col("n_date") == filled, "date")
            .when(F.col("n_flag") == filled, "flag").otherwise("text"))


def merged_report(reports: list[DataFrame], by: str | None = SOURCE_COL) -> DataFrame:
    """One report of several; with ``by=None`` one of all sources together."""
    counts = ["n_rows", "n_filled", *[f"n_{name}" for name in VALUE_KINDS]]
    keys = [by, "column_name"] if by else ["column_name"]
    return reduce(DataFrame.unionByName, reports).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts]).withColumn("type", _type_of())
