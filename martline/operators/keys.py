"""Surrogate keys: dense per-source sequences and content hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..config import ID_CODES, NATURAL_KEY, SOURCE_COL
from ..session import checked_broadcast, ensure_checkpoint_dir, scratch_path, shuffles_removed, split_compiled, with_compiled
from .schema import unregistered


#: Between the parts of a digest; cannot be taken for a part of listing text.
SEPARATOR = "\x1f"


def _sort_keys(cols: list[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_first() for c in cols]


def tag_rows(df: DataFrame, by: list[str], order: list[str], path: str, tiebreak: list[str] | None = None,
             partition_by: list[str] | None = None, seen: Observation | None = None) -> DataFrame:
    """Rows in the order of (by, order), written to ``path`` with their place ``_pid, _mid``; read back.

    Range-partitions on (by, order) and sorts inside partitions, so that every
    partition holds consecutive rows of the global order.  With a tiebreak,
    rows are ordered by (by, order, MD5 of the text columns, tiebreak): the
    range partitioner then samples a few narrow columns, and a hot key (say a
    third of the rows with no property id) is still cut across partitions.
    ``seen`` observes the number of rows written (behind the range
    partitioner, which reads its input once more for a sample).  Shuffle files
    go as soon as the copy is written.
    """
    tiebreak = tiebreak or []
    # Any column but those that order the rows, which the writer goes by.
    split = next((c for c in df.columns if c not in by + order), None)
    if tiebreak:
        texts = [c for c in order + tiebreak if df.schema[c].dataType.simpleString() == "string"]
        row_hash = F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in texts]))
        source = with_compiled(df, "_h", row_hash, split)
        range_keys = _sort_keys(by + order + ["_h"])
        sort_keys = range_keys + _sort_keys(tiebreak)
    else:
        source = df
        range_keys = sort_keys = _sort_keys(by + order)
    ranged = source.repartitionByRange(*range_keys).sortWithinPartitions(*sort_keys)
    tagged = ranged.select(*[split_compiled(F.col(f"`{c}`")).alias(c) if c == split else F.col(f"`{c}`") for c in df.columns], F.spark_partition_id().alias("_pid"),
                           F.monotonically_increasing_id().alias("_mid"))
    writer = (tagged if seen is None else tagged.observe(seen, F.count(F.lit(1)).alias("rows"))).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(tagged.schema).parquet(path)


def write_offsets(tagged: DataFrame, by: list[str], path: str, start: DataFrame | None = None) -> DataFrame:
    """Per (partition, group): the number before its first row, written to ``path``; read back.

    At most partitions x groups rows, from one count over the tagged copy.
    ``start`` (columns ``by`` and ``_start``) continues a group's numbers.
    """
    per_part = tagged.groupBy("_pid", *by).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("_n").over(before), F.lit(0))
    offsets = per_part.select(F.col("_pid").alias("_o_pid"), *[F.col(c).alias(f"_o_{c}") for c in by], "_first", base.alias("_base"))
    if start is not None:
        first = start.select(*[F.col(c).alias(f"_s_{c}") for c in by], "_start")
        cond = [F.col(f"_o_{c}").eqNullSafe(F.col(f"_s_{c}")) for c in by]
        offsets = offsets.join(first, cond, "left").select(
            "_o_pid", *[f"_o_{c}" for c in by], "_first", (F.col("_base") + F.coalesce("_start", F.lit(0))).alias("_base"))
    offsets.write.mode("overwrite").parquet(path)
    return tagged.sparkSession.read.schema(offsets.schema).parquet(path)


def with_numbers(tagged: DataFrame, offsets: DataFrame, by: list[str], name: str,
                 max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """The tagged rows with ``name`` = offset + place in the partition + 1 (tags dropped)."""
    cond = F.col("_pid") == F.col("_o_pid")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    joined = tagged.join(checked_broadcast(offsets, max_broadcast_rows), cond, "inner")
    number = F.col("_base") + F.col("_mid") - F.col("_first") + F.lit(1)
    columns = [c for c in tagged.columns if c not in ("_pid", "_mid")]
    return joined.select(*[F.col(f"`{c}`") for c in columns], number.alias(name))


def sequence_number(df: DataFrame, by: list[str], order: list[str], name: str = "seq",
                    max_broadcast_rows: int = 1_000_000, tiebreak: list[str] | None = None,
                    path: str | None = None, partition_by: list[str] | None = None,
                    seen: Observation | None = None, offsets_path: str | None = None) -> DataFrame:
    """``row_number() over (partition by <by> order by <order>)``, without one task per group.

    A window partitioned by source puts a whole source in one task; a source
    may hold a third of all rows.  Instead ``tag_rows`` writes the rows once in
    global order (to ``path``, or scratch), ``write_offsets`` writes the small
    table of numbers per partition and group once, and the two are joined
    (broadcast after a size check).  Both are read from shared storage, so every use
    sees the same numbers even if executors are lost.

    ``order`` plus ``tiebreak`` must make rows unique within a group (pass
    all remaining columns as ``tiebreak`` when the natural key may repeat) so
    that numbers do not depend on the plan.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    tagged = tag_rows(df, by, order, path or scratch_path(spark, "sequence"), tiebreak, partition_by, seen)
    offsets = write_offsets(tagged, by, offsets_path or scratch_path(spark, "offsets"))
    return with_numbers(tagged, offsets, by, name, max_broadcast_rows).select(
        *[F.col(f"`{c}`") for c in df.columns], name)


def _checked_prefixes(prefixes: DataFrame) -> int:
    """One small job over the source table: its size, no prefix and no source twice."""
    row = prefixes.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_prefix").alias("d"),
                       F.count_distinct("_p_src").alias("s")).first()
    if row["n"] != row["d"]:
        raise ValueError("two sources share an id prefix")
    if row["n"] != row["s"]:
        raise ValueError("a source appears more than once in the source table")
    return row["n"]


def add_surrogate_ids(df: DataFrame, sources: DataFrame, key: str = NATURAL_KEY,
                      codes: dict[str, str] = ID_CODES, path: str | None = None,
                      seen: Observation | None = None, offsets_path: str | None = None) -> DataFrame:
    """Seven ids per row: ``<source prefix><code><n>``, n = 1, 2, ... per source.

    n follows the natural key (then a digest of the texts and the remaining
    columns for rows sharing a key), so the ids are the same on every run and
    every partitioning.  ``sources`` maps ``src`` to its ``prefix``; prefixes
    must be unique (checked on the small table).  ``path`` makes the written
    copy behind the numbers a zone of its own, partitioned by source;
    ``offsets_path`` that of its small table of numbers.
    """
    rest = [c for c in df.columns if c not in (SOURCE_COL, key)]
    numbered = sequence_number(df, [SOURCE_COL], [key], name="_seq", tiebreak=rest, path=path,
                               partition_by=[SOURCE_COL] if path else None, seen=seen, offsets_path=offsets_path)
    return ids_from_numbers(numbered, sources, "_seq", codes)


def ids_from_numbers(numbered: DataFrame, sources: DataFrame, number: str, codes: dict[str, str] = ID_CODES) -> DataFrame:
    """The seven ids in place of the number; a source without a prefix raises."""
    joined = _with_prefix(numbered, sources)
    known = F.coalesce("_prefix", unregistered(F.col(SOURCE_COL)))
    ids = [F.concat(known, F.lit(code), F.col(number).cast("string")).alias(name) for name, code in codes.items()]
    return joined.select(*[F.col(f"`{c}`") for c in numbered.columns if c != number], *ids)


def _with_prefix(df: DataFrame, sources: DataFrame) -> DataFrame:
    prefixes = sources.select(F.col(SOURCE_COL).alias("_p_src"), F.col("prefix").alias("_prefix"))
    n_sources = _checked_prefixes(prefixes)
    return df.join(checked_broadcast(prefixes, known_rows=n_sources), F.col(SOURCE_COL) == F.col("_p_src"), "left")


def _canonical(df: DataFrame, c: str) -> Column:
    """A column as text for a digest: NULL differs from empty, doubles with nine decimals."""
    col = F.col(f"`{c}`")
    if df.schema[c].dataType.simpleString() == "double":
        col = F.coalesce(col.try_cast("decimal(38,9)").cast("string"), col.cast("string"))
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit(""))


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of the columns' values, the same for equal rows only."""
    return F.sha2(F.concat_ws(SEPARATOR, *[_canonical(df, c) for c in columns]), 256)


def add_hash_ids(df: DataFrame, sources: DataFrame, key: str = NATURAL_KEY,
                 codes: dict[str, str] = ID_CODES, carried: tuple[str, ...] = ()) -> DataFrame:
    """Seven ids per row: ``<prefix><code><sha256 of the row>``; no shuffle at all.

    The digest covers every column (source and key first), so rows without a
    key, or sharing one, get different ids as long as the rows are distinct,
    which they are after deduplication.  A changed row gets new ids.
    Columns in ``carried`` take no part in the digest.
    """
    rest = [c for c in df.columns if c not in (SOURCE_COL, key, *carried)]
    digest = row_digest(df, [SOURCE_COL, key, *rest])
    joined = _with_prefix(df, sources)
    known = F.coalesce("_prefix", unregistered(F.col(SOURCE_COL)))
    ids = [F.concat(known, F.lit(code), digest).alias(name) for name, code in codes.items()]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *ids)


def add_monotonic_ids(df: DataFrame, prefix: str | DataFrame, codes: dict[str, str] = ID_CODES) -> DataFrame:
    """Ids from ``monotonically_increasing_id() + 1`` (unique, not dense).

    ``prefix`` is one text for all rows, or the source table with a prefix per
    source.  The frame is checkpointed first so that every table cut from it
    sees the same ids; without that each action would renumber the rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.select("*", (F.monotonically_increasing_id() + F.lit(1)).alias("_n")).checkpoint(eager=True)
    if isinstance(prefix, DataFrame):
        return ids_from_numbers(tagged, prefix, "_n", codes)
    ids = [F.concat(F.lit(prefix), F.lit(code), F.col("_n").cast("string")).alias(name) for name, code in codes.items()]
    return tagged.select(*[F.col(f"`{c}`") for c in df.columns], *ids)
