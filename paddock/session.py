"""Spark session helpers.

Cluster settings (executor sizing, shuffle partitions, checkpoint folder) come
from the cluster's own configuration. The helpers here only fill in what is
unset, which is the situation in local tests and the bench.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading

from pyspark.sql import SparkSession

# Settings every job relies on: UTC day arithmetic, AQE for runtime re-planning
# (partition coalescing and skew-join splitting) and no UI server.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # counts of rows and non-null values from footers, where a reader can do so (sources/tables.py)
    "spark.sql.parquet.aggregatePushdown": "true",
    # plans are built from many column expressions; capturing a Python call
    # site for each costs several JVM round trips per expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "paddock") -> SparkSession:
    """Session for tests and the bench (``local[cpus]``)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("PADDOCK_DRIVER_MEM", "16g")))
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL defaults on an existing session (cluster use)."""
    for k, v in _DEFAULTS.items():
        if k.startswith("spark.ui"):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an already running session
            pass
    return spark


#: Reduce partitions of a shuffle before AQE merges the small ones.
INITIAL_PARTITIONS = 600
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Bytes to which AQE merges them: joins, sorts and windows of one task hold many times that.
MERGED_BYTES = 16 << 20
_MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_SPLITS, _OPEN = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


def grow_partitions(spark: SparkSession) -> SparkSession:
    """Start shuffles with many partitions, unless the cluster says how many. AQE merges
    them up to its advisory size, so that a task's sort or hash table holds about that
    size however large the tables are, not a fixed share of all rows. Scans are cut to that
    size too (a cluster's own choice stays): encoded columns unpack to many times their
    bytes, which a task that shuffles them on would spill."""
    if spark.conf.get(_INITIAL, None) is None:
        spark.conf.set(_INITIAL, str(max(INITIAL_PARTITIONS, shuffle_parts(spark))))
    if spark.conf.get(_MERGED, None) is None:
        spark.conf.set(_MERGED, str(MERGED_BYTES))
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() == 128 << 20:         # Spark's default
        spark.conf.set(_SPLITS, str(MERGED_BYTES))
    return spark


_METHOD = "spark.sql.codegen.hugeMethodLimit"


def compiled_methods(spark: SparkSession) -> SparkSession:
    """The JVM never compiles a method above 8000 bytes: operators whose fused code gets
    longer (wide projections) run one by one, in code that is split into methods."""
    if int(spark.conf.get(_METHOD)) > 8000:
        spark.conf.set(_METHOD, "8000")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is used as is. Where it
    is unset, a private scratch folder is created for a ``local`` master, whose
    tasks all see it; on a cluster that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="paddock-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate files."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/paddock-scratch/{name}-{uuid.uuid4().hex[:12]}"


#: Bytes of a staged file that one task of a model fit reads, and of its row groups.
FIT_SPLIT = 16 << 20
#: Rows of a staged file. Encoded columns say little of the size that their rows unpack to.
FIT_ROWS = 1 << 18


def staged(df, name: str, rows: int | None = None):
    """Write a frame that several jobs read to a scratch folder and read it back:
    computed once, with no cache to release and no lineage to repeat. A file holds
    at most ``rows`` (``FIT_ROWS``) rows."""
    path = scratch_dir(df.sparkSession, name)
    (df.write.option("parquet.block.size", FIT_SPLIT).option("maxRecordsPerFile", rows or FIT_ROWS)
       .option("compression", "zstd").parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


_split_lock, _split_users = threading.Lock(), []


@contextlib.contextmanager
def small_splits(spark: SparkSession):
    """Scans that start inside read at most ``FIT_SPLIT`` bytes (a cluster's smaller
    setting stays) of one file in a task. Spark ML caches what a fit reads, unpacked to many
    times its size in parquet, in blocks of one scan task each: of at most ``FIT_ROWS``
    rows for a staged frame. Fits of several threads share it."""
    with _split_lock:
        if not _split_users:
            before = spark.conf.get(_SPLITS), spark.conf.get(_OPEN)
            _split_users.append(before)
            size = str(min(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes(), FIT_SPLIT))
            spark.conf.set(_SPLITS, size)
            spark.conf.set(_OPEN, size)              # an opened file fills a task
        else:
            _split_users.append(_split_users[0])
    try:
        yield
    finally:
        with _split_lock:
            before = _split_users.pop()
            if not _split_users:
                for key, value in zip((_SPLITS, _OPEN), before, strict=True):
                    spark.conf.set(key, value)


def values_frame(spark: SparkSession, rows, schema: str):
    """Small literal table (thresholds, section maps, messages) as a SQL VALUES
    relation: built in the JVM, no Python-side data transfer."""
    cols = [c.strip().split() for c in schema.split(",")]

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)

    if not rows:
        return spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in cols) + " WHERE false")
    vals = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    names = ", ".join(f"_{i}" for i in range(len(cols)))
    sel = ", ".join(f"CAST(_{i} AS {t}) AS `{n}`" for i, (n, t) in enumerate(cols))
    return spark.sql(f"SELECT {sel} FROM VALUES {vals} AS t({names})")
