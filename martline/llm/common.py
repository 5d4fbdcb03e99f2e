"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.session import read_table, scratch_path

#: Rows that a Python function gets at a time where a table is written.
BATCH_ROWS = 2000

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole driver table, spread over the cores if it is one small file."""
    return read_table(spark, sf_dir, name, spread_rows=True)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    Python functions in the plan get batches of whole texts of at most
    ``BATCH_ROWS`` rows, so that a worker holds few of them at a time.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(_BATCH)
    for paths in _listeners:
        paths.append(path)
    spark.conf.set(_BATCH, str(min(int(before), BATCH_ROWS)) if int(before) > 0 else str(BATCH_ROWS))
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_of(paths: list[str]) -> Iterator[None]:
    """Adds to ``paths`` the folders that ``written`` makes inside the block."""
    _listeners.append(paths)
    try:
        yield
    finally:
        _listeners.remove(paths)


def remove_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders that nothing reads any more and empties the list."""
    context = spark.sparkContext
    while paths:
        path = context._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


_listeners: list[list[str]] = []


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed(df: DataFrame, name: str = "_row") -> DataFrame:
    """All input columns in one struct, so that no name can clash with a working column."""
    return df.select(F.struct(*[df[_quoted(c)] for c in df.columns]).alias(name))


def with_text(df: DataFrame, text_col: str, keep: bool) -> DataFrame:
    """``_row`` as in ``packed``, and the text (null as empty) as ``_text``.

    Without ``keep`` the text is left out of the struct, so that rows written
    or shuffled on the way do not carry it (unless it is the only column).
    """
    rest = [c for c in df.columns if keep or c != text_col] or df.columns
    return df.select(F.struct(*[df[_quoted(c)] for c in rest]).alias("_row"),
                     F.coalesce(df[_quoted(text_col)].cast("string"), F.lit("")).alias("_text"))


def unpacked(df: DataFrame, results: dict[str, Column] | None = None, name: str = "_row") -> DataFrame:
    """The columns of the struct again, then ``results``.

    A result takes the place of an input column of the same name (in any case).
    """
    taken = {c.lower() for c in results or {}}
    fields = [f.name for f in df.schema[name].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col(name).getField(f).alias(f) for f in fields],
                     *[c.alias(k) for k, c in (results or {}).items()])


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` works byte by byte on pure ASCII; other texts go through ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether a row belongs to the fold that nothing is learned from (a null id never does)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def known_labels(labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """``doc_id, label`` outside the held-out fold, one row a document.

    A document labelled more than once takes its largest label; null ids and
    labels other than 0 and 1 are passed over.
    """
    return (labels.filter(~held_out("doc_id", folds, fold) & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))


#: Labelled documents that a text model is trained on, about: those with the smallest hash of their id.
TRAINING_ROWS = 50_000


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int,
                  rows: int = TRAINING_ROWS) -> DataFrame:
    """``id, text, label`` of documents with a known label, written once.

    Of more than ``rows`` labels a share by hash is taken, which comes to
    ``rows`` within a few per cent; that bounds the broadcast of ids and labels,
    and no text is shuffled.
    """
    known = known_labels(labels, label, folds, fold)
    share = min(1.0, rows / max(1, known.count()))
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(round(share * (1 << 20))))
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return written(texts.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), "label"), f"train-{label}")
