"""Mark and sweep: folders that nothing refers to any more, removed after a stated age.

What is in use is read from the commit logs. A folder that isn't goes once its newest file is older
than the age, so a job that is still writing, or a reader that has just opened it, keeps it. Choose the age longer
than the longest job.
"""

from __future__ import annotations

import datetime as dt
import urllib.parse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import remove
from .snapshots import COMMIT_SCHEMA

FOLDERS = "folder string, changed timestamp, bytes bigint"


def folders_below(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(folder, changed, bytes): each folder right below ``root`` with its newest file's time, marker files included.

    Spark lists the files, in parallel when they are many; no file is opened.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(f"{root}/{glob}")
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], FOLDERS)
        raise
    plain = urllib.parse.urlparse(root).path.rstrip("/")
    rest = F.expr("substring(path, locate(root, path) + length(root) + 1)")
    folder = F.split_part(rest, F.lit("/"), F.lit(1))
    files = files.withColumn("root", F.lit(plain))
    return files.groupBy(folder.alias("folder")).agg(
        F.max("modificationTime").alias("changed"), F.sum("length").alias("bytes")
    )


def unused(folders: DataFrame, used: DataFrame, older_than: dt.timedelta, now: dt.datetime | None = None) -> DataFrame:
    """Folders that are not in ``used`` and haven't changed for ``older_than``."""
    limit = (now or dt.datetime.now(dt.timezone.utc)) - older_than
    old = folders.where(F.col("changed") < F.lit(limit))
    return old.join(used.select("folder"), "folder", "left_anti")


def sweep(spark: SparkSession, root: str, found: DataFrame) -> int:
    """Remove these folders below ``root``; how many there were. Their names reach the driver a partition at a time."""
    removed = 0
    for row in found.select("folder").toLocalIterator():
        remove(spark, [f"{root}/{row['folder']}"])
        removed += 1
    return removed


def retire_snapshots(
    spark: SparkSession, root: str, older_than: dt.timedelta, now: dt.datetime | None = None
) -> int:
    """Data folders of snapshots that newer ones replaced that long ago, or that no commit names."""
    try:
        commits = spark.read.schema(COMMIT_SCHEMA).json(f"{root}/commits")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
    limit = (now or dt.datetime.now(dt.timezone.utc)) - older_than
    following = commits.select((F.col("seq") - 1).alias("seq"), F.col("refreshed_at").alias("replaced"))
    kept = commits.join(following, "seq", "left").where(
        F.col("replaced").isNull() | (F.col("replaced") >= F.lit(limit))
    )
    used = kept.select(F.col("snapshot").alias("folder")).distinct()
    return sweep(spark, f"{root}/data", unused(folders_below(spark, f"{root}/data"), used, older_than, now))


def retire_scratch(
    spark: SparkSession, root: str, older_than: dt.timedelta, now: dt.datetime | None = None
) -> int:
    """Stored intermediates below the scratch root: nothing refers to them once their job is over."""
    nothing = spark.createDataFrame([], "folder string")
    found = unused(folders_below(spark, root, "stored-*"), nothing, older_than, now)
    return sweep(spark, root, found)


def retire_runs(
    spark: SparkSession, root: str, older_than: dt.timedelta, now: dt.datetime | None = None
) -> int:
    """Folders by run or batch, such as those of rejected documents."""
    nothing = spark.createDataFrame([], "folder string")
    found = unused(folders_below(spark, root, "*=*"), nothing, older_than, now)
    return sweep(spark, root, found)
