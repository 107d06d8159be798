"""The daily jobs: land new matches, rebuild the models, build the messages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..fixed_values import INGEST_DAYS, STALE_AFTER_SECONDS
from ..functions.dates import as_of_date
from ..functions.text import path_key, strip_isolates
from ..metrics import MetricSpec, match_metrics
from ..operators.assets import manifest_join, pick_random
from ..operators.ingest import (
    CREATED,
    add_source,
    check_roster,
    keys_of,
    limit_per_day,
    new_rows,
    own_day,
    participants_of,
    rounds_of,
)
from ..operators.messages import build_messages, number_messages
from ..operators.records import GameTable, match_games, record_detect
from ..operators.weekly import weekly_avg_kda
from ..schemas import quoted
from ..session import cut_lineage, frees_disk
from ..sources.dimensions import read_manifest
from ..sources.matches import (
    create_participant_table,
    days_of,
    landed_matches,
    read_matches,
    rejected_matches,
    valid_matches,
)
from ..sources.partitions import register_new, write_partitions
from ..sources.snapshots import load_snapshot, write_snapshot
from ..streaming.ingest import STREAMED, ingest_stream, stream_matches, streamed_table
from ..streaming.triggers import dedupe_triggers, on_trigger, read_triggers
from .increments import RecordWindow


@dataclass(frozen=True)
class Places:
    """Where the tables live."""

    root: str
    landing_folder: str = "landing"
    # Catalog table over the participants; days that are new are added to it.
    table: str | None = None
    # JSON files with the image files of each champion.
    images: str | None = None

    @property
    def landing(self) -> str:
        return f"{self.root}/{self.landing_folder}"

    @property
    def participants(self) -> str:
        return f"{self.root}/participants"

    @property
    def streamed(self) -> str:
        return f"{self.root}/streamed"

    @property
    def record_window(self) -> str:
        return f"{self.root}/record_window"

    @property
    def records(self) -> str:
        return f"{self.root}/records"

    @property
    def weekly(self) -> str:
        return f"{self.root}/weekly_kda"

    @property
    def messages(self) -> str:
        return f"{self.root}/messages"

    @property
    def triggers(self) -> str:
        return f"{self.root}/triggers"

    @property
    def ledger(self) -> str:
        return f"{self.root}/handled_triggers"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"

    @property
    def rejected_daily(self) -> str:
        return f"{self.root}/rejected_daily"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/checkpoints"


BY_DAY = GameTable(day="load_date")
# Batches of the ingest stream after which small files are merged.
STREAM_BATCHES_TO_MERGE = 16

STORED = STREAMED
# Number of a stored document.
ROW = "__row"


def read_table(spark: SparkSession, places: Places) -> DataFrame:
    """The participant table, whichever of the two jobs fills it; empty before the first ingest.

    With a catalog table the rows come from there: its partitions are the days that were registered.
    """
    if places.table is not None and spark.catalog.tableExists(places.table):
        return spark.table(places.table).select(*[F.col(quoted(c)) for c in STORED.fieldNames()])
    try:
        return spark.read.schema(STORED).parquet(places.participants)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return streamed_table(spark, places.streamed).read()
        raise


def daily_ingest(
    spark: SparkSession,
    places: Places,
    roster: DataFrame,
    as_of: dt.date | None = None,
    days: int = INGEST_DAYS,
    per_day: int | None = None,
) -> list[dt.date]:
    """Land the roster's documents that are not in the table yet; the days they are of.

    Documents filed in the landing folders of the last ``days`` days are looked at. Each goes to
    the day its game began on. A match is known by player id and match id, so one that
    arrives after others of its day, or in another folder, is loaded as well; found
    twice, it counts once. Running the job again adds nothing. ``per_day`` keeps that many newest matches of a
    player and day only; by default nothing is left out. Documents that are none are
    kept by run under ``rejected_daily``. Their text is parsed once and kept for the steps after it, until the job ends.
    """
    check_roster(roster)
    with frees_disk(spark):
        days_due = _ingest(spark, places, roster, as_of_date(as_of), days, per_day)
    if days_due and places.table is not None:
        register_new(spark, places.table, places.participants)
    return days_due


def _ingest(
    spark: SparkSession, places: Places, roster: DataFrame, day: Column, days: int, per_day: int | None
) -> list[dt.date]:
    filed = F.col("load_date").between(F.date_sub(day, days), F.date_sub(day, 1))
    found = cut_lineage(read_matches(spark, places.landing).where(filed), ROW, "zstd")
    run = F.date_format(day, "yyyy-MM-dd").alias("run")
    rejects = rejected_matches(found).drop(ROW).withColumn("run", run)
    (
        # On the writer, so that no session's setting can remove the rejects of other runs.
        rejects.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("run")
        .parquet(places.rejected_daily)
    )
    tracked = roster.select(strip_isolates(F.col("nickname")).alias("source_nickname")).distinct()
    documents = own_day(add_source(valid_matches(found), F.col("source_nickname")))
    # Whom and what is due is decided by keys; a long roster would have whole documents shuffled.
    due = keys_of(documents, ROW).join(tracked, "source_nickname", "left_semi")
    days_due = days_of(due)
    if places.table is not None:
        create_participant_table(spark, places.table, places.participants)
    if not days_due:
        return []
    fresh = new_rows(due, landed_matches(spark, places.participants, days_due), ROW)
    if per_day is not None:
        newest = [F.col(CREATED).desc(), F.col("match").desc()]
        fresh = limit_per_day(fresh, "source_nickname", "load_date", newest, per_day)
    for part in rounds_of(documents, cut_lineage(fresh.select(ROW), compression="zstd"), ROW):
        keyed = part.withColumn("player_key", path_key(F.col("source_nickname")))
        rows = participants_of(keyed, ("source_nickname", "load_date", "player_key"))
        write_partitions(rows, places.participants)
    return days_due


def build_records(
    spark: SparkSession,
    places: Places,
    roster: DataFrame,
    as_of: dt.date | None = None,
    specs: list[MetricSpec] | None = None,
) -> DataFrame:
    """Record rows of the roster from the participant table."""
    specs = specs or match_metrics()
    games = match_games(read_table(spark, places), specs, BY_DAY)
    return record_detect(games, roster, specs, as_of, table=BY_DAY, carry=("roster_ord",))


def update_records(
    spark: SparkSession,
    places: Places,
    roster: DataFrame,
    as_of: dt.date | None = None,
    specs: list[MetricSpec] | None = None,
    late_days: Iterable[dt.date] = (),
) -> DataFrame:
    """What :func:`build_records` gives, from the stored window and the target day's folder alone.

    ``late_days``: days that got rows since the last run, as :func:`daily_ingest` returns them; of these the
    folders are read once more.
    """
    specs = specs or match_metrics()
    as_of = as_of or spark.range(1).select(F.current_date()).first()[0]
    by_day = replace(BY_DAY, slack=0)
    games = match_games(read_table(spark, places), specs, by_day)
    window = RecordWindow(games, specs, places.record_window, by_day)
    # The target day is read anyway.
    window.refresh_days(day for day in late_days if day < as_of - dt.timedelta(days=1))
    return window.records(roster, as_of, carry=("roster_ord",))


def build_weekly(
    spark: SparkSession, places: Places, roster: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Weekly KDA of the roster from the participant table."""
    participants = read_table(spark, places)
    return weekly_avg_kda(participants, roster, as_of, day_partition=BY_DAY.day)


def refresh_models(
    spark: SparkSession, places: Places, roster: DataFrame, as_of: dt.date | None = None
) -> None:
    """Store records and weekly averages as new snapshots."""
    write_snapshot(build_records(spark, places, roster, as_of), places.records)
    write_snapshot(build_weekly(spark, places, roster, as_of), places.weekly)


def current_messages(
    spark: SparkSession,
    places: Places,
    roster: DataFrame,
    as_of: dt.date | None = None,
    force: bool = False,
    max_age_seconds: int = STALE_AFTER_SECONDS,
) -> DataFrame:
    """Messages of the stored records, which are refreshed when forced or too old."""
    records = load_snapshot(
        spark,
        places.records,
        lambda: build_records(spark, places, roster, as_of),
        force=force,
        max_age_seconds=max_age_seconds,
    )
    messages = build_messages(records)
    return messages if places.images is None else with_images(spark, places, messages)


def with_images(spark: SparkSession, places: Places, messages: DataFrame, seed: int = 0) -> DataFrame:
    """Messages with one image file of their champion, the same one as long as the seed is."""
    picks = pick_random(read_manifest(spark, places.images), seed)
    return manifest_join(messages, picks).drop("champ_norm")


def refresh_messages(
    spark: SparkSession, places: Places, roster: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Force new records, and store their numbered messages."""
    found = current_messages(spark, places, roster, as_of, force=True)
    return write_snapshot(number_messages(found), places.messages)


def serve_triggers(
    spark: SparkSession, places: Places, roster: DataFrame, as_of: dt.date | None = None
) -> StreamingQuery:
    """Handle the waiting triggers: each new one has the messages rebuilt."""

    def refresh(batch: DataFrame, batch_id: int) -> None:
        refresh_messages(spark, places, roster, as_of)

    stream = dedupe_triggers(read_triggers(spark, places.triggers))
    return on_trigger(stream, refresh, f"{places.checkpoints}/triggers", places.ledger)


def stream_ingest(spark: SparkSession, places: Places) -> StreamingQuery:
    """Land new files as they come, into a table with a list of files of its own.

    It is read as long as :func:`daily_ingest` has filled none; use one of the two.
    """
    return ingest_stream(
        stream_matches(spark, places.landing),
        places.streamed,
        f"{places.checkpoints}/ingest",
        places.rejected,
        compact_every=STREAM_BATCHES_TO_MERGE,
    )
