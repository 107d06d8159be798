"""Landed match documents to the participant table, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import add_source, new_matches, own_day, participants_of
from ..schemas import RAW
from ..session import cut_lineage, frees_disk
from ..sources.file_tables import FileTable
from ..sources.matches import (
    CORRUPT,
    days_of,
    match_schema,
    mended,
    rejected_matches,
    valid_matches,
)
from ..sources.partitions import with_player_key
from .triggers import FILES_PER_BATCH, write_by_batch

STREAMED = T.StructType(
    RAW.fields
    + [T.StructField("load_date", T.DateType()), T.StructField("player_key", T.StringType())]
)


def streamed_table(spark: SparkSession, root: str) -> FileTable:
    """The participant table that :func:`ingest_stream` fills, with its list of files."""
    return FileTable(spark, root, STREAMED, sort_by=("player_key",))


def stream_matches(
    spark: SparkSession, landing: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """The landing folder as a stream of documents."""
    return mended(
        spark.readStream.schema(match_schema())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )


def ingest_stream(
    documents: DataFrame,
    table_path: str,
    checkpoint: str,
    rejected_path: str | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Append participant rows batch by batch until the input is used up.

    Each batch is one commit of the table. A batch that was cut short is written again under the
    same name, and one that was committed is left alone, so rows are neither lost nor doubled. A match
    that an earlier batch landed for the player, or that a batch holds twice, counts once.
    Small files are merged after every ``compact_every`` batches; readers aren't disturbed.
    """
    table = streamed_table(documents.sparkSession, table_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with frees_disk(batch.sparkSession):
            take_in(batch, batch_id)
            if compact_every and (batch_id + 1) % compact_every == 0:
                table.compact()

    def take_in(batch: DataFrame, batch_id: int) -> None:
        # Text is parsed once; the days, the rows and the rejects are read from what that gave.
        parsed = cut_lineage(batch, "__row", "zstd")
        name = f"batch-{batch_id}"
        if not table.has_commit(name):
            documents = own_day(add_source(valid_matches(parsed), F.col("source_nickname")))
            days = days_of(documents)
            landed = table.read(F.col("day").isin(days)).select("source_nickname", "`metadata.matchId`")
            fresh = new_matches(documents, landed, "__row")
            table.append(with_player_key(participants_of(fresh, ("source_nickname", "load_date"))), name)
        if rejected_path is not None:
            write_by_batch(rejected_matches(parsed).drop("__row"), batch_id, rejected_path)

    return (
        documents.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
