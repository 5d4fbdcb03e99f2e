"""Exact duplicates by content sort (DataFrame operations only).

Sampled splitters range-partition the normalised bytes, an external sort lays
equal texts side by side, and each text is compared in full with its
neighbour.  Splitters are sampled to the driver, so the range key is a bounded
stand-in for the bytes: their first characters, then their SHA-256, which keeps
texts with a common beginning apart.  The comparison is on the whole text.

A text with more copies than a quarter of a partition's share of rows is sorted in several
salted pieces, and the pieces' representatives go through a second, tiny sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import ascii_lower, packed, shuffle_partitions, unpacked, written

#: Leading characters of the normalised text in the range key.
PREFIX_CHARS = 32
#: A group of copies below this is never split.
MIN_SPLIT_ROWS = 64

_KEY = ("_prefix", "_digest", "_salt")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_split_rows: int = MIN_SPLIT_ROWS) -> DataFrame:
    """Input columns plus ``keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null is the empty
    text.  Of equal texts the row with the largest id stays.  A null id is
    smaller than any other; of rows that share text and id exactly one stays.
    An empty table gives an empty result.  Input columns with a result's name
    are replaced.
    """
    found = _marked(docs, id_col, text_col, min_split_rows)
    return unpacked(found, {c: F.col(f"_{c}") for c in ("keep_id", "group_size", "kept", "text_sha256")})


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that ``exact_dedup`` keeps, with the input columns only."""
    return unpacked(_marked(docs, id_col, text_col, MIN_SPLIT_ROWS).filter("_kept"))


def _marked(docs: DataFrame, id_col: str, text_col: str, min_split_rows: int) -> DataFrame:
    text = F.coalesce(F.col("_row").getField(text_col).cast("string"), F.lit(""))
    base = packed(docs).select(
        "_row", F.col("_row").getField(id_col).alias("_id"),
        ascii_lower(F.substring(text, 1, PREFIX_CHARS)).alias("_prefix"),
        F.sha2(ascii_lower(text), 256).alias("_digest"))

    # At most 4 rows a partition: each has over a quarter of a partition's share of all rows.
    parts = shuffle_partitions(docs.sparkSession)
    share = max(min_split_rows, -(-docs.count() // (4 * parts)))
    hot = written(base.groupBy("_digest").agg(F.count("*").alias("_n")).filter(F.col("_n") > share)
                  .select("_digest", F.ceil(F.col("_n") / share).cast("int").alias("_splits")), "hot-copies")

    def sorted_runs(rows: DataFrame) -> DataFrame:
        """Runs of equal texts inside each (prefix, digest, salt), with their largest id and size."""
        ranged = rows.withColumn(
            "_salt", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_splits")), F.lit(0)).cast("int")
        ).drop("_splits").repartitionByRange(*_KEY)
        order = Window.partitionBy(*_KEY).orderBy("_norm", "_id")
        run = Window.partitionBy(*_KEY, "_run").orderBy(F.col("_id").desc_nulls_last())
        whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return (ranged.withColumn("_norm", ascii_lower(text))
                .withColumn("_new", (~F.col("_norm").eqNullSafe(F.lag("_norm").over(order))).cast("int"))
                .withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
                .drop("_norm", "_new")
                .withColumn("_top", F.max("_id").over(whole))
                .withColumn("_rows", F.count("*").over(whole))
                .withColumn("_at", F.row_number().over(run)))

    found = sorted_runs(base.join(F.broadcast(hot), "_digest", "left"))
    if hot.isEmpty():
        return found.select("_row", F.col("_top").alias("_keep_id"), F.col("_rows").alias("_group_size"),
                            (F.col("_at") == 1).alias("_kept"), F.col("_digest").alias("_text_sha256"))

    # Pieces of split groups: one representative each (at most 8 a partition), sorted and compared again.
    pieces = (sorted_runs(base.join(F.broadcast(hot), "_digest")).filter("_at = 1")
              .select(*_KEY, "_run", "_top", "_rows", ascii_lower(text).alias("_norm")))
    order = Window.partitionBy("_prefix", "_digest").orderBy("_norm", "_salt", "_run")
    group = Window.partitionBy("_prefix", "_digest", "_group")
    merged = written(
        pieces.withColumn("_new", (~F.col("_norm").eqNullSafe(F.lag("_norm").over(order))).cast("int"))
        .withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .select("_digest", "_salt", "_run", F.max("_top").over(group).alias("_all_top"),
                F.sum("_rows").over(group).alias("_all_rows")), "merged-copies")
    found = found.join(F.broadcast(merged.withColumn("_split", F.lit(True))), ["_digest", "_salt", "_run"], "left")
    keep = F.when(F.col("_split"), F.col("_all_top")).otherwise(F.col("_top"))
    return found.select(
        "_row", keep.alias("_keep_id"), F.coalesce("_all_rows", "_rows").alias("_group_size"),
        ((F.col("_at") == 1) & F.col("_top").eqNullSafe(keep)).alias("_kept"),
        F.col("_digest").alias("_text_sha256"))
