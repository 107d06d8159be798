"""Materialised results with a freshness rule.

Each refresh writes a new folder and then one commit row that names it, so
readers of an older folder are never disturbed and a lost job leaves nothing
half-visible. A result that is too old is served while one caller refreshes it in the background.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..fixed_values import STALE_AFTER_SECONDS
from . import leases

COMMIT_SCHEMA = "seq bigint, snapshot string, refreshed_at timestamp, written_rows bigint"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def latest_commit(spark: SparkSession, root: str):
    """Newest commit row with its age in seconds, or None before the first one."""
    try:
        commits = spark.read.schema(COMMIT_SCHEMA).json(f"{root}/commits")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    newest = commits.agg(F.max(F.struct("seq", "refreshed_at", "snapshot", "written_rows")).alias("c"))
    return newest.where("c is not null").select("c.*").first()


def write_snapshot(df: DataFrame, root: str, now: dt.datetime | None = None) -> DataFrame:
    """Store ``df`` as the current snapshot and read it back."""
    spark = df.sparkSession
    name = uuid.uuid4().hex
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.option("compression", "snappy").parquet(f"{root}/data/{name}")
    last = latest_commit(spark, root)
    row = (last["seq"] + 1 if last else 1, name, now or _now(), seen.get["n"])
    commit = spark.createDataFrame([row], COMMIT_SCHEMA)
    commit.coalesce(1).write.mode("append").json(f"{root}/commits")
    return _read(spark, root, name)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    commit = latest_commit(spark, root)
    if commit is None:
        raise FileNotFoundError(f"no snapshot under {root}")
    return _read(spark, root, commit["snapshot"])


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/data/{name}")


def is_stale(refreshed_at: dt.datetime, max_age_seconds: int, now: dt.datetime | None) -> bool:
    """``refreshed_at`` comes from collect, hence in this process's local zone."""
    moment = now or _now()
    if moment.tzinfo is None:
        moment = moment.astimezone()
    return (moment - refreshed_at.astimezone()).total_seconds() > max_age_seconds


def start_refresh(
    spark: SparkSession,
    root: str,
    compute: Callable[[], DataFrame],
    now: dt.datetime | None = None,
) -> InheritableThread:
    """Refresh in a thread of its own, unless another caller is at it.

    The lease is taken in the thread as well, so the caller waits for nothing. A refresh that
    fails leaves the old result in place and the lease free, and the next caller tries again.
    """

    def refresh() -> None:
        lease = leases.acquire(spark, f"{root}/lease")
        if lease is None:
            return
        with lease:
            write_snapshot(compute(), root, now)

    thread = InheritableThread(target=refresh, name=f"refresh of {root}", daemon=True)
    thread.start()
    return thread


#: Refreshes started by this process, by folder; one that ended makes room for the next.
_RUNNING: dict[str, InheritableThread] = {}
_STARTING = threading.Lock()


def refresh_in_background(
    spark: SparkSession,
    root: str,
    compute: Callable[[], DataFrame],
    now: dt.datetime | None = None,
) -> None:
    """Start a refresh of ``root``, unless one is running in this process."""
    with _STARTING:
        running = _RUNNING.get(root)
        if running is None or not running.is_alive():
            _RUNNING[root] = start_refresh(spark, root, compute, now)


def wait_for_refresh(root: str) -> None:
    """Wait for the refresh of ``root`` that this process has started, if one is running."""
    running = _RUNNING.get(root)
    if running is not None:
        running.join()


def load_snapshot(
    spark: SparkSession,
    root: str,
    compute: Callable[[], DataFrame],
    *,
    max_age_seconds: int = STALE_AFTER_SECONDS,
    force: bool = False,
    serve_stale: bool = True,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Current result of ``compute``, recomputed when forced, missing or too old.

    A result that is too old is served at once and refreshed in the background for later
    callers, by one of all callers that find it so; with ``serve_stale`` off this caller computes and waits.
    """
    commit = None if force else latest_commit(spark, root)
    if commit is None:
        return write_snapshot(compute(), root, now)
    if is_stale(commit["refreshed_at"], max_age_seconds, now):
        if not serve_stale:
            return write_snapshot(compute(), root, now)
        refresh_in_background(spark, root, compute, now)
    return _read(spark, root, commit["snapshot"])
