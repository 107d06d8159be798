"""A table as a log of its data files, so that small files can be merged while others read and write.

Data files lie below ``data``, a folder for each commit; ``log`` holds rows (commit, action, path, …). A commit is
one written log file, hence seen whole or not at all. Files that were added and not removed make
up the table, whatever the order of the commits. Readers that hold a list of files keep it: a
merge adds new files and only takes the old ones off the list, and :meth:`FileTable.retire` removes
them once they have been off it for a stated time.

Appends need no lock. Merging takes a lease, so that no two merges replace the same files.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..schemas import quoted
from . import leases
from .retirement import folders_below, remove, sweep, unused

LOG = "commit string, action string, path string, day date, bytes bigint, at timestamp"
FILES = "path string, day date, bytes bigint"
TARGET_BYTES = 256 << 20
#: At most so many files are merged in one commit; their paths reach the driver.
FILES_AT_ONCE = 10_000


def packed(files: DataFrame, target_bytes: int) -> DataFrame:
    """``files`` smaller than the target, with the number of the bin each goes to; bins of one file are left out.

    Files of a day are laid end to end, largest first, and cut at multiples of the target. So a bin is
    at most one small file larger than the target, and a day gets at most one bin for each
    target of its small files' size, and one more.
    """
    small = files.where(F.col("bytes") < target_bytes)
    in_order = Window.partitionBy("day").orderBy(F.col("bytes").desc(), "path")
    before = F.sum("bytes").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes")
    binned = small.withColumn("bin", F.floor(before / F.lit(target_bytes)).cast("int"))
    shared = F.count(F.lit(1)).over(Window.partitionBy("day", "bin"))
    return binned.withColumn("in_bin", shared).where("in_bin > 1").drop("in_bin")


def file_key(path: Column) -> Column:
    """What names a file within its table, however the file system's scheme is spelled."""
    return F.substring_index(path, "/data/", -1)


class FileTable:
    """Rows of ``schema`` below ``root``; ``day`` is the date column that files are cut by."""

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, day: str = "load_date", sort_by: tuple[str, ...] = ()
    ) -> None:
        self.spark, self.root, self.schema, self.day, self.sort_by = spark, root, schema, day, sort_by

    # The log.

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).json(f"{self.root}/log")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], LOG)
            raise

    def files(self) -> DataFrame:
        """Path, day and size of the files that make up the table now."""
        by_file = self.log().groupBy("path").agg(
            F.max("day").alias("day"),
            F.max("bytes").alias("bytes"),
            F.bool_or(F.col("action") == "remove").alias("gone"),
        )
        return by_file.where(~F.col("gone") & F.col("path").isNotNull()).drop("gone")

    def _commit(self, commit: str, added: DataFrame, removed: DataFrame | None = None) -> None:
        """One log file; a commit without files leaves a row of its own, so that it counts as made."""
        rows = added.select(F.lit("add").alias("action"), "path", "day", "bytes")
        made = self.spark.createDataFrame([("add",)], "action string")
        rows = rows.unionByName(made, allowMissingColumns=True)
        if removed is not None:
            rows = rows.unionByName(removed.select(F.lit("remove").alias("action"), "path", "day", "bytes"))
        columns = [F.lit(commit).alias("commit"), "action", "path", "day", "bytes", F.current_timestamp().alias("at")]
        rows.select(*columns).coalesce(1).write.mode("append").json(f"{self.root}/log")

    def has_commit(self, commit: str) -> bool:
        return not self.log().where(F.col("commit") == commit).isEmpty()

    # Rows.

    def _write(self, rows: DataFrame, commit: str, *levels: Column) -> DataFrame:
        """Write the rows into the commit's folder; the files that came of it."""
        folder = f"{self.root}/data/{commit}"
        names = [f"__level{n}" for n in range(len(levels) + 1)]
        placed = rows.withColumns(dict(zip(names, [F.col(quoted(self.day)), *levels])))
        order = [F.col(quoted(c)) for c in (*names, *self.sort_by)]
        columns = [F.col(quoted(c)) for c in (*self.schema.fieldNames(), *names)]
        # Overwriting puts a write that was cut short right.
        placed.sortWithinPartitions(*order).select(*columns).write.mode("overwrite").partitionBy(*names).parquet(folder)
        listed = (
            self.spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True)
            .load(folder)
        )
        day = F.regexp_extract("path", "__level0=([0-9-]+)", 1)
        return listed.select("path", F.when(day != "", day).cast("date").alias("day"), F.col("length").alias("bytes"))

    def append(self, rows: DataFrame, commit: str | None = None) -> bool:
        """Add rows, from the tasks that hold them; false if a commit of that name was made before."""
        commit = commit or uuid.uuid4().hex
        if self.has_commit(commit):
            return False
        self._commit(commit, self._write(rows, commit))
        return True

    def _open(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        # Each file holds its day as a column, so nothing is taken from folder names.
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(*paths)

    def read(self, days: Column | None = None) -> DataFrame:
        """The rows as of now; ``days`` is a condition on ``day`` that picks the files to open.

        The list of files reaches the driver, as it does for any folder that Spark reads; merging bounds it by
        the table's size.
        """
        files = self.files() if days is None else self.files().where(days)
        return self._open([row["path"] for row in files.select("path").collect()])

    # Care.

    def compact(self, target_bytes: int = TARGET_BYTES, files_at_once: int = FILES_AT_ONCE) -> int:
        """Merge small files of each day; how many files were replaced, 0 while another merge is running."""
        lease = leases.acquire(self.spark, f"{self.root}/lease")
        if lease is None:
            return 0
        replaced = 0
        with lease:
            while n := self._merge_some(target_bytes, files_at_once):
                replaced += n
        return replaced

    def _merge_some(self, target_bytes: int, files_at_once: int) -> int:
        commit = uuid.uuid4().hex
        # Whole bins only: their first files stand together.
        found = packed(self.files(), target_bytes).orderBy("day", "bin", "path").limit(files_at_once)
        found = [tuple(row) for row in found.select("path", "day", "bytes", "bin").collect()]
        if len(found) < 2:
            return 0
        plan = self.spark.createDataFrame(found, f"{FILES}, bin int")
        rows = self._open([row[0] for row in found])
        rows = rows.withColumn("__file", file_key(F.col("_metadata.file_path")))
        bins = plan.select(file_key(F.col("path")).alias("__file"), F.col("bin").alias("__bin"))
        # As many rows as files at once: small by construction.
        rows = rows.join(F.broadcast(bins), "__file")
        rows = rows.repartition(F.col(quoted(self.day)), F.col("__bin"))
        written = self._write(rows, commit, F.col("__bin"))
        self._commit(commit, written, plan)
        return len(found)

    def retire(self, older_than: dt.timedelta, now: dt.datetime | None = None) -> int:
        """Remove files that were replaced that long ago, and folders of commits never made."""
        limit = (now or dt.datetime.now(dt.timezone.utc)) - older_than
        log = self.log()
        gone = log.where((F.col("action") == "remove") & (F.col("at") < F.lit(limit))).select("path").distinct()
        removed = 0
        for row in gone.toLocalIterator():
            remove(self.spark, [row["path"]])
            removed += 1
        made = log.select(F.col("commit").alias("folder")).distinct()
        lost = unused(folders_below(self.spark, f"{self.root}/data"), made, older_than, now)
        return removed + sweep(self.spark, f"{self.root}/data", lost)
