"""Session helpers: building a session, shared scratch space, checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side we broadcast: rows, and bytes of their values.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20

# Spark's setting by which an action removes its shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Narrow rows a task takes that are made wide in it (about 1 KB each in memory).
ROWS_PER_TASK = 60_000


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "martline") -> SparkSession:
    """Session with the settings the operators assume (AQE, UTC, no UI)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions do not expose one
        return None


def default_parallelism(spark: SparkSession) -> int:
    """Cores Spark plans for: the context's default parallelism, else the conf."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    value = spark.conf.get("spark.default.parallelism", None) or spark.conf.get("spark.sql.shuffle.partitions")
    return int(value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` (or already set on the
    context) wins.  Only when nothing is set do we choose one ourselves: a
    temporary folder in local mode, else a folder below the warehouse if that
    is on shared storage.  On a cluster whose warehouse is a local folder
    (Spark's default) nothing is shared, and an error says so.
    """
    sc = _context(spark)
    if sc is None:  # Spark Connect: no context here; the server names the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        return configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_martline_checkpoints"
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local"):
            configured = tempfile.mkdtemp(prefix="martline-ckpt-")
        else:
            warehouse = spark.conf.get("spark.sql.warehouse.dir")
            if warehouse.startswith(("file:", "/")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = warehouse.rstrip("/") + "/_martline_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder, removed when the application ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/martline-scratch/{name}-{uuid.uuid4().hex}"
    sc = _context(spark)
    if sc is not None:  # through Spark's own file systems, so that any shared store works
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions begun inside remove their shuffle files when they end; else these stay until the driver happens to collect its garbage.

    For writes whose copy is read from then on, so that shuffles of wide rows do not pile up on disk.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can use a local-mode path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return path


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   known_rows: int | None = None, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    One job over the small side counts its rows (up to the bound) and the
    bytes of their values; callers that know an upper bound of rows of fixed
    width pass ``known_rows``.
    """
    if known_rows is not None:
        return known_rows <= max_rows
    width = sum((F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))
                                           if f.dataType.simpleString() not in ("string", "binary") else F.col(f"`{f.name}`")),
                            F.lit(0)) + 16 for f in df.schema.fields), F.lit(0))
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return row["n"] <= max_rows and row["bytes"] <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      known_rows: int | None = None, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when it is within both bounds (``fits_broadcast``).

    Beyond either bound the frame is returned as is and the join falls back to a shuffle join.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, known_rows, max_bytes) else df


def split_compiled(c: Column) -> Column:
    """The column as it is, bound to a lambda's variable: keeps the projection it stands in out of whole-stage code.

    Projections of fifty computed columns would become one method, which is
    too long to be compiled well; outside they are compiled in small ones.
    """
    return F.transform(F.array(c), lambda v: v)[0]


def with_compiled(df: DataFrame, name: str, c: Column, through: str) -> DataFrame:
    """``df`` with a long computed column, its projection kept out of whole-stage code by the column ``through``.

    Only ``through`` passes a lambda's variable, whose body is interpreted; the
    computed column itself is compiled, in small methods.
    """
    return df.select(*[split_compiled(F.col(f"`{k}`")).alias(k) if k == through else F.col(f"`{k}`") for k in df.columns], c.alias(name))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a frame whose scan gives fewer partitions than the cluster
    has cores (one unsplittable file, say).  Planning only, no job; a large
    input already has enough splits and is returned untouched, so this never
    adds a shuffle at scale.
    """
    target = min_partitions or default_parallelism(df.sparkSession)
    try:
        n = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. Spark Connect): leave as is
        return df
    return df.repartition(target) if n < target else df


def tasks_for(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks over which narrow rows are dealt out before they are made wide: one for every ``rows_per_task``, at least one a core.

    For frames read from files, whose count reads no rows.  What a task sorts,
    groups or writes later then does not grow with the input.
    """
    return max(default_parallelism(df.sparkSession), -(-df.count() // rows_per_task))


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    """A driver table.  ``spread_rows`` spreads a single-split table over the cores."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if spread_rows else df
