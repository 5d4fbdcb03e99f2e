"""Reading listing files, uniting sources, landing raw copies, writing tables."""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Iterator, Mapping
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..config import SOURCE_COL

log = logging.getLogger(__name__)

# CSV options shared by reads and writes: quoted fields may hold commas,
# quotes (doubled) and line breaks; spaces around values are kept.
CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true", "enforceSchema": "false",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# Tables we write tell NULL from the empty text, which raw listing files do not.
TABLE_CSV_OPTIONS = {**CSV_OPTIONS, "nullValue": "\\N"}

# Settings of the session that reads headers: every file is one task, and few
# lines reach Python before it stops.
HEADER_SETTINGS = {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40),
                   "spark.sql.files.maxPartitionNum": str((1 << 31) - 1), "spark.sql.execution.arrow.maxRecordsPerBatch": "256"}
# Batches read on behind a header: a worker that ends a short file can be used again, one that leaves a long file cannot.
READ_ON = 64
HEADER_SCHEMA = "src string, file string, header array<string>"


def read_csv_source(spark: SparkSession, path: str, lineage: bool = False, multi_line: bool = True) -> DataFrame:
    """One source: CSV files with a header row, every value text.

    No schema is passed and nothing is inferred: columns are named by the
    header of the files, so each source may have its own columns.  All files of
    a source must have the same header: one whose columns differ, or come in
    another order, raises instead of being bound by position.  Folders
    are read recursively.  ``lineage=True`` adds ``source_file``, the file
    each row came from (Spark's hidden ``_metadata`` column, no extra scan).
    ``multi_line=False`` lets Spark split large files of a source whose values
    hold no line breaks.
    """
    df = (spark.read.options(**CSV_OPTIONS)
          .option("multiLine", str(multi_line).lower())
          .option("recursiveFileLookup", "true")
          .option("inferSchema", "false")
          .csv(path))
    if lineage:
        df = df.select("*", F.col("_metadata.file_path").alias("source_file"))
    return df


def _united(frames: list[DataFrame]) -> DataFrame:
    """All frames by column name; joined two by two, so that plans of many sources stay shallow."""
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1], allowMissingColumns=True) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]


def _stamped(name: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(name).alias(SOURCE_COL), *[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def union_sources(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Stamp each frame with its source name and unite them by column name.

    Columns a source lacks come back as NULL; one plan, so one job scans all
    sources.
    """
    if not frames:
        raise ValueError("no sources")
    return _united([_stamped(name, df) for name, df in frames.items()])


def _first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The header of the one file that a task reads; little of a long file is read."""
    place = []

    def lines() -> Iterator[str]:
        for batch in batches:
            for row in batch.to_pylist():
                place[:] = [row["src"], row["file"]]
                if row["multi"]:
                    yield row["value"] + "\n"
                elif row["value"].strip():
                    yield row["value"]
                    return

    header = next((fields for fields in csv.reader(lines()) if fields), None)
    if header is not None:
        yield pa.RecordBatch.from_arrays([pa.array([place[0]]), pa.array([place[1]]), pa.array([header], pa.list_(pa.string()))],
                                         names=["src", "file", "header"])
    for _ in zip(range(READ_ON), batches):
        pass


def source_headers(spark: SparkSession, registry: Mapping[str, str], multi_line: Mapping[str, bool]) -> DataFrame:
    """``src, file, header``: the column names of every file of every source, in one pass over their beginnings.

    One task a file; it reads the first record and stops.  Files without any
    line give no row.
    """
    reader = spark.newSession()
    for key, value in HEADER_SETTINGS.items():
        reader.conf.set(key, value)
    texts = [reader.read.option("recursiveFileLookup", "true").text(path).select(
        F.lit(name).alias("src"), F.col("_metadata.file_path").alias("file"), F.lit(multi_line[name]).alias("multi"), "value")
        for name, path in registry.items()]
    return _united(texts).mapInArrow(_first_record, HEADER_SCHEMA)


def _header_groups(headers: DataFrame) -> list[Row]:
    """``src, header, files`` per source and header; ``files`` only where a source has several headers."""
    found = headers.groupBy("src", "header").agg(F.collect_list("file").alias("files"))
    several = F.count(F.lit(1)).over(Window.partitionBy("src")) > 1
    return sorted(found.select("src", "header", F.when(several, F.col("files")).alias("files")).collect(),
                  key=lambda r: (r.src, r.header))


def _literal_path(file: str) -> str:
    """A file's name as Spark reports it, as a path to read: unescaped, and no character of it a wildcard."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def _column_names(header: list[str]) -> list[str]:
    """Names as Spark's CSV reader gives them: ``_c<n>`` for an empty one, the place added to repeated ones."""
    folded = [n.lower() for n in header]
    return [f"_c{i}" if not n else f"{n}{i}" if folded.count(n.lower()) > 1 else n for i, n in enumerate(header)]


def _read_group(spark: SparkSession, path: str, group: Row, multi_line: bool) -> DataFrame:
    names = _column_names(group.header)
    schema = StructType()
    for n in names:
        schema.add(n, StringType())
    # Names that had to be made up, or that hold line breaks, cannot be compared while reading.
    plain = names == group.header and not any("\n" in n or "\r" in n for n in names)
    reader = (spark.read.options(**CSV_OPTIONS).schema(schema).option("enforceSchema", str(not plain).lower())
              .option("multiLine", str(multi_line).lower()).option("recursiveFileLookup", "true"))
    return reader.csv(path if group.files is None else [_literal_path(f) for f in sorted(group.files)])


def read_sources(spark: SparkSession, registry: Mapping[str, str], multi_line: bool | Mapping[str, bool] = True) -> DataFrame:
    """``{source name: path}`` -> one frame with a ``src`` column.

    Files are grouped by source and header (``source_headers``, one job for
    all sources however many), read group by group and united by column name,
    so files of one source may differ in the order and number of columns.
    A file's header is checked again while its rows are read, unless names
    repeat, are empty or hold line breaks (repeated ones get their place added, empty ones
    are ``_c<place>``).  A source whose files hold no line gives no rows and is warned about; if there is
    no line at all, ``ValueError``.  ``multi_line`` says, for all sources or by
    name (others: true), whether values may hold line breaks; if not, Spark
    splits large files.
    """
    if not registry:
        raise ValueError("no sources")
    breaks = {name: multi_line if isinstance(multi_line, bool) else multi_line.get(name, True) for name in registry}
    groups = _header_groups(source_headers(spark, registry, breaks))
    empty = sorted(set(registry) - {g.src for g in groups})
    if empty:
        log.warning("sources without a header line: %s", ", ".join(empty))
    if not groups:
        raise ValueError("no file of any source has a header line")
    return _united([_stamped(g.src, _read_group(spark, registry[g.src], g, breaks[g.src])) for g in groups])


def land_by_source(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write raw rows to a raw zone, one folder per source (``src=<name>``).

    Values are written as they are (all text for raw listings), so nothing is
    re-typed on the way.
    """
    writer = df.write.mode(mode).partitionBy(SOURCE_COL)
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.format(fmt).save(path)


def raw_zone_registry(spark: SparkSession, path: str, sources: list[str]) -> dict[str, str]:
    """Registry of a landed raw zone: source name -> its folder."""
    base = path.rstrip("/")
    return {s: f"{base}/{SOURCE_COL}={s}" for s in sources}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", compression: str | None = None,
                mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Write one output table.  ``fmt="csv"`` writes a header row and quotes
    fields; ``compression="gzip"`` compresses it.  Parquet is the default."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        writer.options(**TABLE_CSV_OPTIONS).csv(path)
    else:
        writer.format(fmt).save(path)


def write_raw(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rows as raw listing files: CSV with a header, NULL as nothing."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_written(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read back a table written by ``write_table``.

    Pass the schema to get the types back: CSV stores text, and the values of
    partition folders (``src=007``) would otherwise be guessed to be numbers.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        return reader.options(**TABLE_CSV_OPTIONS).csv(path)
    return reader.format(fmt).load(path)


def read_landed(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The raw zone as one frame: ``columns`` and the source, all text."""
    schema = ", ".join(f"`{c}` string" for c in [*columns, SOURCE_COL])
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path).select(SOURCE_COL, *[f"`{c}`" for c in columns])


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Register tables as temporary views for SQL; returns the view names."""
    names = []
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system that Spark reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder and all in it, on any file system that Spark writes; nothing if there is none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
