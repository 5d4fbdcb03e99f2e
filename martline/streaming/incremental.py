"""Incremental ingestion: only files not seen before, exactly once.

A Structured Streaming file source remembers which files it has read in its
checkpoint; ``trigger(availableNow=True)`` reads what is new and stops.  The
file sink commits each batch atomically, so a rerun after a failure neither
loses nor repeats rows.  One checkpoint per source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..config import SOURCE_COL
from ..plans import increments
from ..sources.files import CSV_OPTIONS, union_sources


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def ingest_new_files(spark: SparkSession, source_path: str, columns: list[str], sink_path: str,
                     checkpoint: str, sink_format: str = "parquet",
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Copy rows of files that arrived since the last run into ``sink_path``.

    ``columns`` are the header names of the source (all text).  Headers are
    checked against them (``enforceSchema=false``) rather than bound by
    position.  Blocks until the new files are processed.
    """
    query = _started(spark, source_path, columns, sink_path, checkpoint, sink_format, max_files_per_trigger)
    query.awaitTermination()
    return query


def _new_rows(spark: SparkSession, source_path: str, columns: list[str], max_files_per_trigger: int | None) -> DataFrame:
    reader = (spark.readStream.schema(text_schema(columns))
              .options(**CSV_OPTIONS).option("enforceSchema", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(source_path)


def _started(spark: SparkSession, source_path: str, columns: list[str], sink_path: str, checkpoint: str,
             sink_format: str, max_files_per_trigger: int | None = None) -> StreamingQuery:
    stream = _new_rows(spark, source_path, columns, max_files_per_trigger)
    return (stream.writeStream.format(sink_format)
            .option("path", sink_path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def stream_increments(spark: SparkSession, name: str, source_path: str, columns: list[str], sources: DataFrame, out_dir: str,
                      checkpoint: str, max_files_per_trigger: int | None = None, ledger_name: str | None = None,
                      **options) -> StreamingQuery:
    """Files of a source that arrived since the last run, taken straight into the star schema.

    Each micro-batch is one increment (``plans.increments.run_increment``,
    which takes ``options``), known to its ledger as ``<name>/<batch id>``.  A
    batch that was published before the stream could note it comes again after
    a restart and changes nothing; one that was not is taken whole.  Rows that
    other batches brought are left out, so a stream begun anew (under another
    ``ledger_name``) repeats none.  Blocks until the new files are processed.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(F.lit(name).alias(SOURCE_COL), *[F.col(f"`{c}`") for c in columns])
        increments.run_increment(batch.sparkSession, rows, sources, out_dir, f"{ledger_name or name}/{batch_id}", **options)

    query = (_new_rows(spark, source_path, columns, max_files_per_trigger).writeStream.foreachBatch(take)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def ingest_sources(spark: SparkSession, registry: dict[str, tuple[str, list[str]]], sink_root: str,
                   checkpoint_root: str, sink_format: str = "parquet", at_once: int = 16) -> dict[str, str]:
    """Incremental ingestion of several sources, one stream and one checkpoint each.

    ``registry`` maps a source name to (folder, header columns).  Each source
    lands in its own sink ``<sink_root>/src=<name>``; ``at_once`` streams run side by
    side, and if one fails those that still run are stopped (their next run goes
    on from their checkpoints).  Returns the sink folder per source; read them with ``read_sinks``.
    """
    base_sink, base_ckpt = sink_root.rstrip("/"), checkpoint_root.rstrip("/")
    sinks = {name: f"{base_sink}/src={name}" for name in registry}
    names = list(registry)
    for at in range(0, len(names), at_once):
        running: list[StreamingQuery] = []
        try:
            for name in names[at:at + at_once]:
                path, columns = registry[name]
                running.append(_started(spark, path, columns, sinks[name], f"{base_ckpt}/{name}", sink_format))
            for query in running:
                query.awaitTermination()
        finally:
            for query in running:
                query.stop()
    return sinks


def read_sinks(spark: SparkSession, sinks: dict[str, str], sink_format: str = "parquet") -> DataFrame:
    """The committed rows of several sinks, with their source.

    Each sink is read by its own folder, so that its commit log decides which
    files count; a read of the common root would also take files of a batch
    that failed.
    """
    return union_sources({name: spark.read.format(sink_format).load(path) for name, path in sinks.items()})
