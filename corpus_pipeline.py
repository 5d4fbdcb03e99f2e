"""Training-corpus pipeline over ``documents``, one text operator a stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read back as the next stage's input.  A stage therefore
begins by removing the working tables of the stage before it: nothing reads
them once that stage's result is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from martline.llm.common import remove_scratch, scratch_of, table, written
from martline.llm.exact_dedup import drop_copies
from martline.llm.fertility import keep_quality
from martline.llm.packing import pack_digests
from martline.llm.pii import redact_pii
from martline.llm.simhash import drop_near_copies


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_quality(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of every group of equal texts."""
    return drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of every component of near-equal fingerprints."""
    return drop_near_copies(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    return redact_pii(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in full sequences."""
    return pack_digests(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_scratch: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """The stage, after the working tables of the one before have been removed."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_scratch(spark, _scratch)
        with scratch_of(_scratch):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_rules", _tidy(quality_stage)),
    ("exact_dedup", _tidy(exact_dedup_stage)),
    ("simhash_near_dedup", _tidy(near_dedup_stage)),
    ("pii", _tidy(pii_stage)),
    ("packing", _tidy(packing_stage)),
]

#: Tokeniser measures, fingerprints and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the whole table; the pieces of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
