"""Record windows that grow by a day and lose a day, without reading the days between again.

A *day summary* holds a player's best game of one day for every metric. Summaries merge: the better
key of two is the best of both. So the best of a window of days is kept as two stacks:

* ``back``: one row a player, the best of all days since the stacks were last turned;
* ``front``: for the days up to then, the best from each day to the turning day, one row for each
  player-day. Moving the window's first day on picks another row; nothing is recomputed.

Once the window has left all days of ``front``, the stacks are turned: ``front`` is made from the
summaries of the window's days, and ``back`` starts empty. Each summary is read twice in its
life, by the merge into ``back`` and by one turn.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import game_date, in_days
from ..functions.values import better_first
from ..metrics import MetricSpec
from ..schemas import quoted
from .records import GAMES, GameTable, best_games


def games_of_days(
    games: DataFrame, first: dt.date, last: dt.date, table: GameTable = GAMES, only: list[dt.date] | None = None
) -> DataFrame:
    """Games from ``first`` to ``last``; ``only``: of these days alone."""
    rows = games.where(in_days(games, table.time, F.lit(first), F.lit(last), table.day, table.slack))
    if only is not None:
        rows = rows.where(game_date(games, table.time).isin(only))
        if table.day is not None:
            shifts = range(-table.slack, table.slack + 1)
            folders = {d + dt.timedelta(days=n) for d in only for n in shifts}
            rows = rows.where(F.col(quoted(table.day)).isin(sorted(folders)))
    return rows


def day_summaries(
    games: DataFrame,
    specs: list[MetricSpec],
    first: dt.date,
    last: dt.date,
    table: GameTable = GAMES,
    only: list[dt.date] | None = None,
) -> DataFrame:
    """Best games of every player and day from ``first`` to ``last``: nickname, day, a struct a metric.

    ``only``: of these days alone.
    """
    rows = games_of_days(games, first, last, table, only)
    day = game_date(games, table.time).alias("day")
    player = F.col(quoted(table.player)).alias("nickname")
    return rows.groupBy(player, day).agg(*best_games(games, specs, table))


def keys_of(summaries: DataFrame, specs: list[MetricSpec]) -> DataFrame:
    """Only the keys: history needs neither match nor champion."""
    others = [F.col(c) for c in ("nickname", "day") if c in summaries.columns]
    return summaries.select(
        *others, *[F.col(f"{quoted(s.name)}.key").alias(s.name) for s in specs]
    )


def merge_keys(keys: DataFrame, specs: list[MetricSpec]) -> DataFrame:
    """One row a player: the better of all keys."""
    best = [F.min(quoted(s.name)).alias(s.name) for s in specs]
    return keys.groupBy("nickname").agg(*best)


def turned(keys: DataFrame, specs: list[MetricSpec]) -> DataFrame:
    """``front``: for each player-day the best from that day to the last one.

    A row stands for all first days after ``after`` up to ``upto``: in between the player
    has no games, so the best is the same. A player has at most one row for each day of the window.
    """
    latest_first = Window.partitionBy("nickname").orderBy(F.col("day").desc())
    so_far = latest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return keys.select(
        "nickname",
        F.lead("day").over(latest_first).alias("after"),
        F.col("day").alias("upto"),
        *[F.min(quoted(s.name)).over(so_far).alias(s.name) for s in specs],
    )


def window_best(
    front: DataFrame, back: DataFrame, first: dt.date, specs: list[MetricSpec]
) -> DataFrame:
    """``hist_`` values of every player over the days from ``first`` on."""
    begins = F.lit(first)
    older = front.where(
        (F.col("after").isNull() | (F.col("after") < begins)) & (F.col("upto") >= begins)
    )
    keys = older.drop("after", "upto").unionByName(back)
    best = merge_keys(keys, specs)
    values = [
        better_first(F.col(quoted(s.name)), best.schema[s.name].dataType, s.agg).alias(f"hist_{s.name}")
        for s in specs
    ]
    return best.select("nickname", *values)
