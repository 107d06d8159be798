"""Calendar columns.

Day boundaries are those of ``spark.sql.session.timeZone``. Filters compare the
stored column with constant bounds, so they fold to literals and reach the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import quoted


def as_of_date(as_of: dt.date | str | Column | None = None) -> Column:
    """The reference day of a run; today when not given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def target_day(as_of=None) -> Column:
    return F.date_sub(as_of_date(as_of), 1)


def history_days(as_of=None, lookback_days: int = 31) -> tuple[Column, Column]:
    """First and last day (both included) of the window before the target day."""
    day = as_of_date(as_of)
    return F.date_sub(day, lookback_days + 1), F.date_sub(day, 2)


def week_start(day: Column) -> Column:
    """Monday of the week; plain date arithmetic, so no time zone is involved."""
    return F.date_sub(day, F.weekday(day))


def full_weeks(as_of=None, weeks: int = 5) -> tuple[Column, Column]:
    """First and last day of the ``weeks`` complete weeks before the current one."""
    monday = week_start(as_of_date(as_of))
    return F.date_sub(monday, 7 * weeks), F.date_sub(monday, 1)


def ingest_days(as_of=None, days: int = 7) -> Column:
    """Array of the ``days`` days before ``as_of``."""
    day = as_of_date(as_of)
    return F.sequence(F.date_sub(day, days), F.date_sub(day, 1))


def epoch_ms_to_date(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def day_start_ms(day: Column) -> Column:
    return F.unix_millis(day.cast("timestamp"))


def day_bounds_seconds(day: Column) -> tuple[Column, Column]:
    """Epoch seconds of the day's start and of the next day's start."""
    return (
        F.unix_seconds(day.cast("timestamp")),
        F.unix_seconds(F.date_add(day, 1).cast("timestamp")),
    )


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def game_date(df: DataFrame, column: str) -> Column:
    """Calendar day of an epoch-ms, timestamp or date column."""
    value = F.col(quoted(column))
    if isinstance(df.schema[column].dataType, T.LongType):
        return epoch_ms_to_date(value)
    return F.to_date(value)


def in_days(
    df: DataFrame,
    column: str,
    first: Column,
    last: Column,
    day_partition: str | None = None,
    slack: int = 1,
) -> Column:
    """Rows whose day is in ``[first, last]``, as a half-open range on the stored column.

    ``day_partition`` names the partition column of a table laid out by day, so
    that only those folders are opened. They may differ from the row's own day
    by ``slack`` days, at the edge of a day.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.LongType):
        low, high = day_start_ms(first), day_start_ms(F.date_add(last, 1))
    else:
        low, high = first.cast(kind), F.date_add(last, 1).cast(kind)
    value = F.col(quoted(column))
    inside = (value >= low) & (value < high)
    if day_partition is not None:
        folder = F.col(quoted(day_partition))
        inside = folder.between(F.date_sub(first, slack), F.date_add(last, slack)) & inside
    return inside
