"""Daily records from stored window state: a run reads one day of games.

Under ``root`` lie ``days`` (day summaries, a folder a day), ``stacks`` (a folder for each written
stack) and ``commits`` (one row for each day the window has taken in, naming its stacks). A run that is cut short
leaves folders nobody names; the next one starts from the last commit. Repeating a day's run
starts from the state before that day and gives the same rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import LOOKBACK_DAYS
from ..functions.dates import game_date
from ..metrics import MetricSpec
from ..operators.increments import day_summaries, games_of_days, keys_of, merge_keys, turned, window_best
from ..operators.records import GAMES, GameTable, beaten_records
from ..session import frees_disk

COMMIT = "seq bigint, through date, turned date, front string, back string, late date"
ONE_DAY = dt.timedelta(days=1)
# Games summarised at once, unless one day has more.
GAMES_A_ROUND = 2_000_000


@dataclass(frozen=True)
class Stacks:
    """The window's state after a day: where its stacks are."""

    seq: int
    through: dt.date
    turned: dt.date
    front: str
    back: str | None


class RecordWindow:
    """The last ``lookback_days`` days of games as mergeable summaries under ``root``.

    ``games`` has one column for each of ``specs``; only days that the window hasn't taken in are read from it. It
    should be laid out by day, with ``table.day`` set and ``table.slack`` 0, so that one folder is opened for a day.
    """

    def __init__(
        self,
        games: DataFrame,
        specs: list[MetricSpec],
        root: str,
        table: GameTable = GAMES,
        lookback_days: int = LOOKBACK_DAYS,
    ) -> None:
        self.spark: SparkSession = games.sparkSession
        self.games, self.specs, self.root, self.table = games, specs, root, table
        self.lookback_days = lookback_days

    # State.

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(COMMIT).json(f"{self.root}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _state(self, day: dt.date) -> Stacks | None:
        """The newest state through ``day`` or the last day before it; one row reaches the driver.

        A state that has taken in a day before late games of that day were known is passed over.
        """
        commits = self._commits()
        if commits is None:
            return None
        late = commits.where("late is not null").select(F.col("seq").alias("known"), F.col("late").alias("of"))
        states = commits.where(F.col("through") <= F.lit(day)).drop("late")
        outdated = (F.col("known") > F.col("seq")) & (F.col("of") <= F.col("through"))
        newest = F.max(F.struct("through", "seq", "turned", "front", "back")).alias("c")
        row = states.join(F.broadcast(late), outdated, "left_anti").agg(newest).first()["c"]
        return row and Stacks(row["seq"], row["through"], row["turned"], row["front"], row["back"])

    def _commit(self, *values) -> int:
        """Append a row of through, turned, front, back and late."""
        commits = self._commits()
        last = commits.agg(F.max("seq")).first()[0] if commits is not None else None
        seq = (last or 0) + 1
        rows = self.spark.createDataFrame([(seq, *values)], COMMIT).coalesce(1)
        rows.write.mode("append").json(f"{self.root}/commits")
        return seq

    def _store(self, stack: DataFrame) -> str:
        name = uuid.uuid4().hex
        with frees_disk(self.spark):
            stack.write.parquet(f"{self.root}/stacks/{name}", compression="zstd")
        return name

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/stacks/{name}")

    # Days.

    def summarise(self, first: dt.date, last: dt.date, only: list[dt.date] | None = None) -> None:
        """Write the summaries of these days anew, from the games of these days alone.

        All days at once, or as many as have ``GAMES_A_ROUND`` games, which bounds the disk that shuffles take.
        """
        for begins, ends, some in self._rounds(first, last, only):
            found = day_summaries(self.games, self.specs, begins, ends, self.table, some)
            with frees_disk(self.spark):
                (
                    found.withColumn("summary_day", F.col("day"))
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .option("compression", "zstd")
                    .partitionBy("summary_day")
                    .parquet(f"{self.root}/days")
                )

    def _rounds(
        self, first: dt.date, last: dt.date, only: list[dt.date] | None
    ) -> list[tuple[dt.date, dt.date, list[dt.date] | None]]:
        """First day, last day and days of each round; a count a day reaches the driver."""
        if first == last:
            return [(first, last, only)]
        games = games_of_days(self.games, first, last, self.table, only)
        sizes = games.groupBy(game_date(games, self.table.time).alias("day")).count().orderBy("day")
        rounds: list[tuple[list[dt.date], int]] = []
        for day, count in sizes.collect():
            if rounds and rounds[-1][1] + count <= GAMES_A_ROUND:
                rounds[-1] = ([*rounds[-1][0], day], rounds[-1][1] + count)
            else:
                rounds.append(([day], count))
        if len(rounds) < 2:
            return [(first, last, only)]
        return [(days[0], days[-1], days) for days, _ in rounds]

    def summaries(self, first: dt.date, last: dt.date) -> DataFrame:
        # The schema is that of no rows at all, so that days without games can be read as well.
        kinds = day_summaries(self.games.limit(0), self.specs, first, first, self.table).schema
        days = self.spark.read.schema(kinds.add("summary_day", "date")).parquet(f"{self.root}/days")
        inside = F.col("summary_day").between(F.lit(first), F.lit(last))
        return days.where(inside).drop("summary_day")

    def _days(self, first: dt.date, last: dt.date) -> list[dt.date]:
        return [first + n * ONE_DAY for n in range((last - first).days + 1)]

    def _summarised(self) -> set[dt.date]:
        """Days that have summaries: folder names, at most one for each day there ever was."""
        try:
            days = self.spark.read.schema("summary_day date").parquet(f"{self.root}/days")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return set()
            raise
        rows = days.select("summary_day").distinct().collect()
        return {row[0] for row in rows}

    def _keys(self, first: dt.date, last: dt.date) -> DataFrame:
        return keys_of(self.summaries(first, last), self.specs)

    def _first_day(self, last: dt.date) -> dt.date:
        return last - (self.lookback_days - 1) * ONE_DAY

    def _turn(self, through: dt.date) -> Stacks:
        """Make ``front`` from the summaries of the window that ends on ``through``."""
        front = self._store(turned(self._keys(self._first_day(through), through), self.specs))
        return Stacks(self._commit(through, through, front, None, None), through, through, front, None)

    def _take_in(self, state: Stacks, day: dt.date) -> Stacks:
        """The state after ``day``, whose summaries are there."""
        if state.turned < self._first_day(day):
            return self._turn(day)
        keys = self._keys(day, day).drop("day")
        if state.back is not None:
            keys = self._read(state.back).unionByName(keys)
        back = self._store(merge_keys(keys, self.specs))
        seq = self._commit(day, state.turned, state.front, back, None)
        return Stacks(seq, day, state.turned, state.front, back)

    def _through(self, day: dt.date) -> Stacks:
        """The state after ``day``; days missed so far are taken in one by one, a long gap at once."""
        state = self._state(day)
        first = self._first_day(day)
        if state is None or state.through < first:
            there = self._summarised()
            missing = [d for d in self._days(first, day) if d not in there]
            if missing:
                self.summarise(missing[0], missing[-1])
            return self._turn(day)
        while state.through < day:
            missed = state.through + ONE_DAY
            self.summarise(missed, missed)
            state = self._take_in(state, missed)
        return state

    # Results.

    def refresh_days(self, days: Iterable[dt.date]) -> None:
        """Take in games that came late: the summaries of these days anew, from these days' games alone.

        States that hold the days without those games are passed over from now on; the next run turns the
        stacks once from the summaries. Days the window hasn't reached yet need nothing.
        """
        there = self._summarised()
        late = sorted(day for day in set(days) if day in there or self._reached(day))
        if late:
            self.summarise(late[0], late[-1], late)
            self._commit(None, None, None, None, late[0])

    def _reached(self, day: dt.date) -> bool:
        state = self._state(dt.date.max)
        return state is not None and day <= state.through

    def records(self, roster: DataFrame, as_of: dt.date, carry: tuple[str, ...] = ()) -> DataFrame:
        """What ``record_detect`` gives for that day; the window has taken the target day in afterwards."""
        target = as_of - ONE_DAY
        state = self._through(target - ONE_DAY)
        self.summarise(target, target)
        after = self._state(target)
        if after is None or after.through < target:
            self._take_in(state, target)
        front = self._read(state.front)
        back = self._read(state.back) if state.back else front.drop("after", "upto").limit(0)
        first = target - self.lookback_days * ONE_DAY
        history = window_best(front, back, first, self.specs)
        today = self.summaries(target, target).drop("day")
        return beaten_records(today, history, roster, self.specs, carry)
