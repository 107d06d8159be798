"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # Column expressions are generated for dozens of metrics; recording a Python
    # call site for each would cost more time than planning them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# On a cluster shuffles start with many partitions, which adaptive execution
# merges to the advisory size; the default of 200 would make them too large to sort
# in memory long before a table reaches the terabytes.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(app_name: str = "matchpeaks", master: str | None = None, **conf) -> SparkSession:
    """A session with this library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**SESSION_CONF, **given}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        for key in CLUSTER_CONF.keys() - given.keys():
            spark.conf.set(key, CLUSTER_CONF[key])
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, or a temporary one in local mode.

    A cluster without ``spark.checkpoint.dir`` is an error: a folder on the
    driver's machine would be lost or unseen by executors.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="matchpeaks-"))
    return (shared or context.getCheckpointDir()).rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root; nothing is created there yet."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Let costly per-row work use all cores when a table scan comes in few splits.

    Large inputs have more splits than cores and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# Folders that the job around a call has stored, oldest first.
_stored: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("stored", default=None)
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def frees_disk(spark: SparkSession) -> Iterator[None]:
    """For jobs that return nothing lazy: what they have stored on the way is removed at the end of the block.

    Shuffle files go when the query that wrote them ends, instead of when the driver next collects garbage.
    Only folders of :func:`cut_lineage` calls in the block are removed. The setting is the session's and put back.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    outer = _stored.set([])
    try:
        yield
    finally:
        for path in _stored.get():
            remove(spark, [path])
        _stored.reset(outer)
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Remove files or folders on whatever file system they are."""
    jvm = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        target = jvm.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame, row: str | None = None, compression: str = "snappy") -> DataFrame:
    """Store ``df`` in the shared folder and read it back.

    A written table keeps columns apart, so a later pass over one of them reads
    only that one. ``row`` adds a column of that name with a number for each row, unique and stored; numbers of
    one file are next to each other.
    """
    if row is not None:
        df = df.withColumn(row, F.monotonically_increasing_id())
    path = scratch_dir(df.sparkSession, "stored")
    if (stored := _stored.get()) is not None:
        stored.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
