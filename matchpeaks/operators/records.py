"""Record detection: the target day against the days before it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import LOOKBACK_DAYS
from ..functions.dates import history_days, in_days, target_day
from ..functions.text import join_meta, own_row
from ..functions.values import better_first, no_nan
from ..metrics import GAME_COLUMNS, MetricSpec
from ..schemas import quoted


@dataclass(frozen=True)
class GameTable:
    """Column names of a table of games (or of any actor–event–time table)."""

    player: str = "source_nickname"
    match: str = "match_id"
    champion: str = "champion_name"
    time: str = "game_creation_ts"
    # Partition column with the day, for tables laid out by day.
    day: str | None = None
    # Days by which a row's folder may differ from its own day: 0 if it was written in this session's time zone.
    slack: int = 1


GAMES = GameTable()


def own_rows(participants: DataFrame) -> DataFrame:
    """Rows in which the participant is the tracked player."""
    return participants.where(
        own_row(
            F.col("source_nickname"),
            F.col("`participant.riotIdGameName`"),
            F.col("`participant.riotIdTagline`"),
        )
    )


def base_metrics(participants: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns the metrics need, under short names."""
    columns = [F.col(quoted(raw)).alias(short) for short, raw in GAME_COLUMNS.items()]
    return participants.select("source_nickname", *columns, *[F.col(quoted(k)) for k in keep])


def derived_metrics(
    games: DataFrame, specs: list[MetricSpec], table: GameTable = GAMES
) -> DataFrame:
    """Ids, time and every metric computed for each game."""
    ids = dict.fromkeys([table.player, table.match, table.champion, table.time])
    if table.day is not None:
        ids[table.day] = None
    return games.select(
        *[F.col(quoted(name)) for name in ids],
        *[F.expr(spec.sql).alias(spec.name) for spec in specs if spec.name not in ids],
    )


def for_player(df: DataFrame, nickname: str, player: str = "source_nickname") -> DataFrame:
    return df.where(F.col(quoted(player)) == nickname)


def in_roster(df: DataFrame, roster: DataFrame, player: str = "source_nickname") -> DataFrame:
    """Rows of tracked players.

    With a long roster, put it after an aggregation where that is possible; the
    optimizer moves it in front by itself when the roster is small.
    """
    names = roster.select(F.col("nickname").alias(player))
    return df.join(names, player, "left_semi")


def today_metrics(
    games: DataFrame, specs: list[MetricSpec], as_of=None, table: GameTable = GAMES
) -> DataFrame:
    """Per player, the best game of the target day for every metric.

    Each metric becomes a struct (key, match, champion), so value, match and
    champion always come from one game; of equal games the lowest match id wins.
    """
    day = target_day(as_of)
    rows = games.where(in_days(games, table.time, day, day, table.day, table.slack))
    best = best_games(games, specs, table)
    return rows.groupBy(F.col(quoted(table.player)).alias("nickname")).agg(*best)


def best_games(
    games: DataFrame, specs: list[MetricSpec], table: GameTable = GAMES
) -> list[Column]:
    """Aggregates that give each metric's best game as a struct (key, match, champion)."""
    match = F.col(quoted(table.match)).alias("match")
    champion = F.col(quoted(table.champion)).alias("champion")
    best = []
    for spec in specs:
        kind = games.schema[spec.name].dataType
        value = no_nan(F.col(quoted(spec.name)), kind)
        candidate = F.struct(better_first(value, kind, spec.agg).alias("key"), match, champion)
        best.append(F.min(F.when(value.isNotNull(), candidate)).alias(spec.name))
    return best


def historical_best(
    games: DataFrame,
    specs: list[MetricSpec],
    as_of=None,
    lookback_days: int = LOOKBACK_DAYS,
    table: GameTable = GAMES,
    prefix: str = "hist_",
) -> DataFrame:
    """Per player, the best value of the window before the target day.

    Plain ``max``/``min`` buffers keep this pass, which reads nearly all rows,
    in hash aggregation; only the single target day carries match and champion.
    """
    first, last = history_days(as_of, lookback_days)
    rows = games.where(in_days(games, table.time, first, last, table.day, table.slack))
    best = []
    for spec in specs:
        value = no_nan(F.col(quoted(spec.name)), games.schema[spec.name].dataType)
        pick = F.max(value) if spec.agg == "max" else F.min(value)
        best.append(pick.alias(prefix + spec.name))
    return rows.groupBy(F.col(quoted(table.player)).alias("nickname")).agg(*best)


def strict_record(today: Column, best: Column, agg: str) -> Column:
    """Strictly better; unknown (hence no record) when either side is NULL."""
    return today > best if agg == "max" else today < best


def record_detect(
    games: DataFrame,
    roster: DataFrame,
    specs: list[MetricSpec],
    as_of=None,
    lookback_days: int = LOOKBACK_DAYS,
    table: GameTable = GAMES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per roster entry: each new record with its ``match-_-champion``.

    ``games`` needs the id and time columns of ``table`` and one column per
    spec. A player who has no games, or none on the target day, gets NULLs.

    The two windows do not overlap, so with a table laid out by day every file
    is read once. Each window is reduced to one row per player before anything
    is joined, so a player holding much of the table costs no more than others.
    ``carry`` names roster columns to keep. For a few players of a table that
    holds many, pass ``in_roster(games, roster)`` as ``games``.
    """
    today = today_metrics(games, specs, as_of, table)
    history = historical_best(games, specs, as_of, lookback_days, table)
    return beaten_records(today, history, roster, specs, carry)


def beaten_records(
    today: DataFrame,
    history: DataFrame,
    roster: DataFrame,
    specs: list[MetricSpec],
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Record rows of the roster from each player's best games and ``hist_`` values."""
    # A record needs both sides, so players missing in one can be left out here.
    compared = today.join(history, "nickname", "inner")
    columns = []
    for spec in specs:
        kind = today.schema[spec.name].dataType["key"].dataType
        best_game = F.col(quoted(spec.name))
        value = better_first(best_game["key"], kind, spec.agg)
        beaten = strict_record(value, F.col(quoted("hist_" + spec.name)), spec.agg)
        meta = join_meta(best_game["match"], best_game["champion"])
        columns.append(F.when(beaten, value).alias(spec.name))
        columns.append(F.when(beaten, meta).alias(f"{spec.name}_meta"))
    found = compared.select("nickname", *columns)
    names = [name for spec in specs for name in (spec.name, f"{spec.name}_meta")]
    return roster.join(found, "nickname", "left").select(
        *[F.col(quoted(name)) for name in (*names, *carry)],
        F.col("nickname").alias("source_nickname"),
    )


def match_games(
    participants: DataFrame, specs: list[MetricSpec], table: GameTable = GAMES
) -> DataFrame:
    """Metric rows of the tracked players' own games, from the participant table."""
    keep = () if table.day is None else (table.day,)
    return derived_metrics(base_metrics(own_rows(participants), keep), specs, table)
