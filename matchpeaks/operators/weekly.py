"""Weekly averages of per-game ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import WEEKS_BACK
from ..functions.dates import full_weeks, game_date, in_days, week_start
from ..functions.values import at_least_one, truncated_ratio
from ..schemas import quoted
from .records import in_roster, own_rows

MEAN_DIGITS = 9


def kda(kills: Column, assists: Column, deaths: Column) -> Column:
    """Takedowns per death, counting no deaths as one."""
    return (kills + assists).cast("double") / at_least_one(deaths)


def _mean(ratio: Column, scale: int | None) -> Column:
    """Mean to two digits; or, with a scale, the mean of fixed-scale decimals.

    The mean is rounded to nine digits first, so that the order in which tasks
    add up never decides which way a tie is rounded.

    With a scale, each ratio and then the mean are rounded to ``scale`` digits,
    half up, in whole numbers. That is what decimal division and average give in
    engines that keep the scale of their inputs.
    """
    if scale is None:
        return F.round(F.round(F.avg(ratio), MEAN_DIGITS), 2)
    unit = 10**scale
    scaled = F.round(F.round(ratio, scale) * unit).cast("bigint")
    total, count = F.sum(scaled), F.count(scaled)
    size = truncated_ratio(2 * F.abs(total) + count, 2 * count)
    signed = F.when(total < 0, -size).otherwise(size)
    return (signed.cast("decimal(22, 0)") / unit).cast(f"decimal(22, {scale})")


def weekly_average(
    games: DataFrame,
    ratio: Column,
    roster: DataFrame,
    as_of=None,
    weeks: int = WEEKS_BACK,
    player: str = "source_nickname",
    time: str = "game_creation_ts",
    result: str = "avg_kda",
    decimal_scale: int | None = None,
    day_partition: str | None = None,
) -> DataFrame:
    """Mean of ``ratio`` per player and week over the last complete weeks.

    Rows shrink to one per player and week inside each task. The roster filter
    follows the aggregation: a small roster is moved before it by the optimizer,
    a large one then meets the few aggregated rows only.
    """
    first, last = full_weeks(as_of, weeks)
    rows = games.where(in_days(games, time, first, last, day_partition)).select(
        F.col(quoted(player)).alias("source_nickname"),
        week_start(game_date(games, time)).alias("week_start"),
        ratio.alias("__ratio"),
    )
    averaged = rows.groupBy("source_nickname", "week_start").agg(
        _mean(F.col("__ratio"), decimal_scale).alias(result)
    )
    return in_roster(averaged, roster)


def weekly_avg_kda(
    participants: DataFrame,
    roster: DataFrame,
    as_of=None,
    weeks: int = WEEKS_BACK,
    own_rows_only: bool = False,
    decimal_scale: int | None = None,
    day_partition: str | None = None,
) -> DataFrame:
    """Weekly KDA of the participant table.

    All participants of a tracked player's matches count unless
    ``own_rows_only`` is set.
    """
    rows = own_rows(participants) if own_rows_only else participants
    ratio = kda(
        F.col("`participant.kills`"),
        F.col("`participant.assists`"),
        F.col("`participant.deaths`"),
    )
    return weekly_average(
        rows,
        ratio,
        roster,
        as_of,
        weeks,
        time="info.gameCreation",
        decimal_scale=decimal_scale,
        day_partition=day_partition,
    )


def order_weeks(weekly: DataFrame) -> DataFrame:
    """Newest week first, then by player; a reading order, not kept by table writes."""
    return weekly.orderBy(F.col("week_start").desc(), F.col("source_nickname"))
