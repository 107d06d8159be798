"""Trigger messages as a stream: each one forces a refresh of the results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import TRIGGER

DUPLICATE_WINDOW = "2 minutes"
FILES_PER_BATCH = 1000


def read_triggers(
    spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Messages that arrive as JSON lines; any source with the same columns will do."""
    reader = spark.readStream.schema(TRIGGER).option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def publish_trigger(messages: DataFrame, path: str) -> None:
    """Append messages (msg_id, ts, payload) to the folder the stream reads."""
    messages.select(*TRIGGER.fieldNames()).write.mode("append").json(path)


def dedupe_triggers(
    triggers: DataFrame, window: str = DUPLICATE_WINDOW, salted: bool = True
) -> DataFrame:
    """Each message id once within ``window`` of its arrival.

    The window goes by the time a batch takes a message in, not by the time the message
    bears: a message is never late, however old it is, and its first copy is always handled.
    A message sent over and over would meet in one task. Dropping repeats per
    input partition first leaves at most one row per partition for that id.
    """
    arrived = "__arrived"
    marked = triggers.withColumn(arrived, F.current_timestamp()).withWatermark(arrived, window)
    if salted:
        marked = (
            marked.withColumn("__salt", F.spark_partition_id())
            .dropDuplicatesWithinWatermark(["msg_id", "__salt"])
            .drop("__salt")
        )
    return marked.dropDuplicatesWithinWatermark(["msg_id"]).drop(arrived)


def on_trigger(
    triggers: DataFrame,
    refresh: Callable[[DataFrame, int], None],
    checkpoint: str,
    ledger: str | None = None,
) -> StreamingQuery:
    """Call ``refresh(batch, batch_id)`` for every batch that holds a message.

    The position moves on only after ``refresh`` returned; a batch whose refresh
    failed comes again on restart, with the same id. ``ledger`` keeps the
    handled messages by batch, so a repeated batch replaces its own entry; with it, a message
    that an earlier batch handled is not handled again, however long ago that was.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        # One full pass over the batch: a partial one would leave the duplicate
        # filter's state of the other partitions unsaved.
        batch.persist()
        try:
            if batch.count() == 0:
                return
            fresh = batch if ledger is None else unhandled(batch, batch_id, ledger)
            if fresh.isEmpty():
                return
            refresh(fresh, batch_id)
            if ledger is not None:
                write_by_batch(fresh, batch_id, ledger)
        finally:
            batch.unpersist()

    return (
        triggers.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def unhandled(batch: DataFrame, batch_id: int, ledger: str) -> DataFrame:
    """Messages of the batch, each id once, that no other batch has entered in the ledger.

    The ledger is reduced to the batch's ids first. That side is small, so the ledger's one column is
    filtered where it is read and isn't shuffled.
    """
    once = batch.dropDuplicates(["msg_id"])
    try:
        entries = batch.sparkSession.read.schema("msg_id string, batch_id bigint").parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return once
        raise
    others = entries.where(F.col("batch_id") != batch_id).select("msg_id")
    known = others.join(once.select("msg_id"), "msg_id", "left_semi")
    return once.join(known, "msg_id", "left_anti")


def write_by_batch(
    rows: DataFrame,
    batch_id: int,
    path: str,
    partition_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
) -> None:
    """Write a batch into folders of its own; writing it again replaces them.

    Rows stay in the tasks they are in. Gathering them by folder would send a
    batch, which mostly holds one day, to one task: inside a stream nothing
    splits such a partition afterwards.
    """
    levels = (*partition_by, "batch_id")
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .sortWithinPartitions(*levels, *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*levels)
        .parquet(path)
    )
