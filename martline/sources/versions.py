"""Published versions of a folder of tables: all of a run's tables at once, or none.

A table is a folder of parts, ``<base>/<table>/part=<tag>``; a run writes its
parts under a tag of its own and touches no other.  What counts is said by the
latest manifest, one small file that is renamed into place when all parts are
written: readers of an older manifest keep their parts, and a run that dies
before leaves nothing but folders that no manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from ..config import SOURCE_COL
from .files import TABLE_CSV_OPTIONS, write_table

PART = "part"
#: Tables whose parts are partitioned by a column of their own.
PARTITIONED = {"booking": SOURCE_COL}
#: Keys by which tables are laid out for joins.  Locations belong to one listing each, so these buckets are even.
LAYOUT_KEYS = {"booking": "locationId", "location": "locationId", "host": "hostId"}


@dataclass
class Table:
    """The parts of one table, their columns (as Spark's JSON) and format."""

    parts: list[str]
    schema: str
    fmt: str = "parquet"


@dataclass
class Manifest:
    """One version: its tables, the batches in it (name -> fingerprint) and other small facts."""

    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    batches: dict[str, str] = field(default_factory=dict)
    facts: dict[str, str | None] = field(default_factory=dict)


def new_tag(name: str) -> str:
    """A part's name that no other run has."""
    return f"{name}-{uuid.uuid4().hex[:12]}"


def _folder(base: str) -> str:
    return f"{base.rstrip('/')}/_manifest"


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def _versions(spark: SparkSession, base: str) -> list[int]:
    fs, folder = _file_system(spark, _folder(base))
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[2:-5]) for n in names if n.startswith("v-") and n.endswith(".json"))


def _name(base: str, version: int) -> str:
    return f"{_folder(base)}/v-{version:010d}.json"


def read_manifest(spark: SparkSession, base: str, version: int | None = None) -> Manifest:
    """The latest manifest, or that of a version; an empty one (version 0) where nothing is published."""
    known = _versions(spark, base)
    if version is None and not known:
        return Manifest()
    text = spark.read.text(_name(base, known[-1] if version is None else version), wholetext=True).first()[0]
    found = json.loads(text)
    return Manifest(found["version"], {k: Table(**v) for k, v in found["tables"].items()}, found["batches"], found["facts"])


def publish(spark: SparkSession, base: str, manifest: Manifest) -> Manifest:
    """Makes the manifest the latest version, which must follow the one it was made from."""
    fs, final = _file_system(spark, _name(base, manifest.version))
    _, draft = _file_system(spark, f"{_folder(base)}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(asdict(manifest)).encode("utf-8")))
    finally:
        out.close()
    known = _versions(spark, base)
    if fs.exists(final) or (known[-1] if known else 0) != manifest.version - 1 or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"version {manifest.version} of {base} was published by another run")
    return manifest


def write_part(df: DataFrame, base: str, name: str, tag: str, fmt: str = "parquet", compression: str | None = None,
               partition_by: list[str] | None = None) -> Table:
    """One part of a table, written under its tag; counts once a manifest names it."""
    write_table(df, f"{base.rstrip('/')}/{name}/{PART}={tag}", fmt=fmt, compression=compression, partition_by=partition_by)
    return Table([tag], df.schema.json(), fmt)


def added(before: Table | None, part: Table) -> Table:
    """The table with one part more."""
    if before is not None and before.fmt != part.fmt:
        raise ValueError(f"the table was begun as {before.fmt}")
    return part if before is None else Table([*before.parts, *part.parts], part.schema, part.fmt)


def read_table(spark: SparkSession, base: str, name: str, table: Table, columns: list[str] | None = None,
               with_part: bool = False) -> DataFrame:
    """A version's table in one scan, however many parts it has."""
    schema = StructType.fromJson(json.loads(table.schema))
    root = f"{base.rstrip('/')}/{name}"
    reader = spark.read.schema(StructType([*schema.fields]).add(PART, StringType())).option("basePath", root).format(table.fmt)
    if table.fmt == "csv":
        reader = reader.options(**TABLE_CSV_OPTIONS)
    names = (columns or schema.names) + ([PART] if with_part else [])
    return reader.load([f"{root}/{PART}={p}" for p in table.parts]).select(*[f"`{c}`" for c in names])


def read_tables(spark: SparkSession, base: str, version: int | None = None) -> dict[str, DataFrame]:
    """The published tables (those without a leading underscore) of the latest version, or of one that is kept."""
    manifest = read_manifest(spark, base, version)
    return {n: read_table(spark, base, n, t) for n, t in manifest.tables.items() if not n.startswith("_")}


def expire(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Removes manifests but the last ``keep``, and the parts that only removed ones or dead runs name.

    For the only writer of a folder: parts of a run that is still writing are in no manifest either.
    """
    known = _versions(spark, base)
    kept = [read_manifest(spark, base, v) for v in known[-keep:]]
    named = {(n, p) for m in kept for n, t in m.tables.items() for p in t.parts}
    for version in known[:-keep]:
        fs, path = _file_system(spark, _name(base, version))
        fs.delete(path, False)
    for name in {n for m in kept for n in m.tables}:
        fs, folder = _file_system(spark, f"{base.rstrip('/')}/{name}")
        for part in fs.listStatus(folder) if fs.exists(folder) else []:
            tag = part.getPath().getName()
            if tag.startswith(f"{PART}=") and (name, tag.removeprefix(f"{PART}=")) not in named:
                fs.delete(part.getPath(), True)


def attach_tables(spark: SparkSession, base: str, database: str) -> list[str]:
    """Catalog tables ``database.name`` over the latest version's tables; returns their names.

    With a persistent catalog (Hive support) they outlive the session, and any
    SQL client of that catalog can read them; the data stays where it is.  The
    parts of the version are partitions of the table, whose own partitions
    (the fact's sources) come below; attaching again follows the latest version.
    """
    manifest, base = read_manifest(spark, base), base.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{base}'")
    out = []
    for name, table in manifest.tables.items():
        if name.startswith("_"):
            continue
        full, fields = f"`{database}`.`{name}`", StructType.fromJson(json.loads(table.schema)).fields
        inner = [f.name for f in fields if name in PARTITIONED and f.name == PARTITIONED[name]]
        columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{PART}` string"])
        keys = ", ".join(f"`{c}`" for c in [PART, *inner])
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        options = ", ".join(f"'{k}' '{v}'" for k, v in TABLE_CSV_OPTIONS.items()).replace("\\", "\\\\") if table.fmt == "csv" else ""
        spark.sql(f"CREATE TABLE {full} ({columns}) USING {table.fmt} " + (f"OPTIONS ({options}) " if options else "")
                  + f"PARTITIONED BY ({keys}) LOCATION '{base}/{name}'")
        spark.sql(f"MSCK REPAIR TABLE {full}")
        found = {r[0].split("/")[0].removeprefix(f"{PART}=") for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}
        for part in found - set(table.parts):
            spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION ({PART}='{part}')")
        out.append(f"{database}.{name}")
    return out


def lay_out_tables(spark: SparkSession, base: str, database: str, buckets: int,
                   keys: Mapping[str, str] = LAYOUT_KEYS) -> dict[str, DataFrame]:
    """Catalog tables ``database.name``, copies of the latest version's tables in ``buckets`` sorted buckets by key.

    Tables of one key and number of buckets join on it without a shuffle.
    One shuffle a table writes it, one file a bucket.  A key that holds a large share
    of a table's rows (a hot host in the fact) would fill one bucket; the
    default keys do not repeat within their tables.  The tables stay as they are until they
    are laid out again; they change one after another, so readers that need
    them of one version take a database per version.  Folders of earlier layouts
    (``<base>/_layout/v<version>-...``) are left to whoever knows that nobody reads them.
    """
    manifest, base = read_manifest(spark, base), base.rstrip("/")
    missing = sorted(set(keys) - set(manifest.tables))
    if missing:
        raise ValueError(f"not published in {base}: {', '.join(missing)}")
    folder = f"{base}/_layout/{new_tag(f'v{manifest.version}')}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{base}/_layout/_database'")
    out = {}
    for name, key in keys.items():
        full = f"`{database}`.`{name}`"
        rows = read_table(spark, base, name, manifest.tables[name])
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        # The shuffle places rows as buckets do, so that every task writes whole buckets.
        (rows.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
         .option("path", f"{folder}/{name}").saveAsTable(full))
        out[name] = spark.table(full)
    return out
