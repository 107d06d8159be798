import dataclasses
import datetime as dt
import random

import pytest

from matchpeaks.metrics import MetricSpec
from matchpeaks.operators import increments as operators, records
from matchpeaks.plans import increments
from matchpeaks.plans.increments import RecordWindow
from matchpeaks.sources.partitions import write_partitions

TABLE = records.GameTable("player", "match", "champion", "at", day="load_date", slack=0)
SPECS = [MetricSpec("score"), MetricSpec("loss", "min"), MetricSpec("flag"), MetricSpec("real")]
SCHEMA = (
    "player string, match string, champion string, at timestamp, load_date date,"
    " score bigint, loss double, flag boolean, real double"
)
DAY = dt.timedelta(days=1)
START = dt.date(2024, 3, 1)


def games_of(rng, days, players="abcdef"):
    rows = []
    for n in days:
        for player in players:
            for _ in range(rng.choice([0, 0, 1, 2])):
                day = START + n * DAY
                at = dt.datetime(day.year, day.month, day.day, rng.randrange(24), rng.randrange(60))
                some = lambda x: rng.choice([None, x, x])
                rows.append(
                    (player, f"m{rng.randrange(10**6)}", rng.choice("XYZ"), at, day,
                     some(rng.randrange(9)), some(rng.choice([float("nan"), rng.random()])),
                     some(rng.random() < 0.3), some(rng.random()))
                )
    return rows


def table_of(spark, tmp_path, rows):
    path = str(tmp_path / "games")
    write_partitions(spark.createDataFrame(rows, SCHEMA), path, sort_by=("player",))
    return path


def roster_of(spark):
    return spark.createDataFrame([(p,) for p in "abcdefz"], "nickname string")


def same(spark, window, path, as_of, lookback):
    games = spark.read.parquet(path)
    expected = records.record_detect(games, roster_of(spark), SPECS, as_of, lookback, TABLE)
    found = window.records(roster_of(spark), as_of)
    assert found.columns == expected.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    return found


def window_of(spark, path, tmp_path, lookback):
    return RecordWindow(spark.read.parquet(path), SPECS, str(tmp_path / "window"), TABLE, lookback)


def test_ten_days_equal_the_whole_computation(spark, tmp_path):
    lookback = 3
    path = table_of(spark, tmp_path, games_of(random.Random(lookback), range(18)))
    found = []
    for n in range(8, 18):
        window = window_of(spark, path, tmp_path, lookback)
        same(spark, window, path, START + n * DAY, lookback)
        found.append(window._state(dt.date.max))
    assert [s.through for s in found] == [START + (n - 1) * DAY for n in range(8, 18)]
    # Turned once a window's length, not every day.
    assert len({s.turned for s in found}) <= 2 + 10 // lookback


def test_missed_days_a_long_gap_and_a_repeat(spark, tmp_path):
    path = table_of(spark, tmp_path, games_of(random.Random(9), range(40)))
    window = window_of(spark, path, tmp_path, 4)
    for n in (8, 10, 10, 9, 30):
        same(spark, window, path, START + n * DAY, 4)


def test_late_games_change_repeats_and_later_runs(spark, tmp_path):
    rng = random.Random(11)
    path = table_of(spark, tmp_path, games_of(rng, range(14)))
    window = window_of(spark, path, tmp_path, 5)
    for n in (9,):
        same(spark, window, path, START + n * DAY, 5)
    late = [("a", "late", "X", dt.datetime(2024, 3, 7, 12), dt.date(2024, 3, 7), 100, -1.0, True, 2.0)]
    write_partitions(spark.createDataFrame(late, SCHEMA), path, sort_by=("player",))
    window = window_of(spark, path, tmp_path, 5)
    window.refresh_days([dt.date(2024, 3, 7), dt.date(2025, 1, 1)])
    for n in (9, 10):
        same(spark, window, path, START + n * DAY, 5)


def test_a_day_without_games_becomes_one_with(spark, tmp_path):
    rng = random.Random(12)
    path = table_of(spark, tmp_path, [r for r in games_of(rng, range(12)) if r[4] != START + 6 * DAY])
    window = window_of(spark, path, tmp_path, 5)
    same(spark, window, path, START + 9 * DAY, 5)
    write_partitions(spark.createDataFrame(games_of(rng, [6]), SCHEMA), path, sort_by=("player",))
    window = window_of(spark, path, tmp_path, 5)
    window.refresh_days([START + 6 * DAY])
    same(spark, window, path, START + 9 * DAY, 5)


def test_no_games_at_all(spark, tmp_path):
    games = spark.createDataFrame([], SCHEMA)
    window = RecordWindow(games, SPECS, str(tmp_path / "window"), TABLE, 3)
    rows = window.records(roster_of(spark), START).collect()
    assert len(rows) == 7 and all(r["score"] is None for r in rows)


def test_a_run_opens_one_folder(spark, tmp_path):
    path = table_of(spark, tmp_path, games_of(random.Random(3), range(12)))
    day = START + 5 * DAY
    found = operators.day_summaries(spark.read.parquet(path), SPECS, day, day, TABLE)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "(load_date#" in plan and f">= {day})" in plan and f"<= {day})" in plan
    wider = dataclasses.replace(TABLE, slack=1)
    assert operators.day_summaries(spark.read.parquet(path), SPECS, day, day, wider).count() == found.count()


def test_a_player_with_most_games_sends_one_row_a_task(spark, tmp_path):
    """Summaries are combined before the shuffle."""
    path = table_of(spark, tmp_path, games_of(random.Random(3), range(3)))
    found = operators.day_summaries(spark.read.parquet(path), SPECS, START, START, TABLE)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") >= len(SPECS)


def test_late_days_are_summarised_in_one_job(spark, tmp_path, monkeypatch):
    path = table_of(spark, tmp_path, games_of(random.Random(3), range(8)))
    window = RecordWindow(spark.read.parquet(path), SPECS, str(tmp_path / "window"), TABLE, 5)
    window.records(roster_of(spark), START + 8 * DAY)
    before = sorted(window.summaries(START, START + 7 * DAY).collect(), key=str)
    summarise, calls = RecordWindow.summarise, []
    monkeypatch.setattr(RecordWindow, "summarise", lambda self, *days: calls.append(days) or summarise(self, *days))
    window.refresh_days([START + n * DAY for n in (3, 4, 6)])
    assert len(calls) == 1
    assert sorted(window.summaries(START, START + 7 * DAY).collect(), key=str) == before


@pytest.mark.parametrize("day", ["load_date", None])
def test_days_with_many_games_are_summarised_in_rounds(spark, tmp_path, monkeypatch, day):
    table = dataclasses.replace(TABLE, day=day)
    path = table_of(spark, tmp_path, games_of(random.Random(4), [0, 1, 2, 4, 5, 6]))
    games = spark.read.parquet(path)
    once = RecordWindow(games, SPECS, str(tmp_path / "once"), table, 5)
    last = START + 6 * DAY
    once.summarise(START, last)
    written, summaries = [], increments.day_summaries

    def seen(games, specs, first, last, table, only=None):
        written.append(only)
        return summaries(games, specs, first, last, table, only)

    monkeypatch.setattr(increments, "day_summaries", seen)
    monkeypatch.setattr(increments, "GAMES_A_ROUND", 9, raising=False)
    rounds = RecordWindow(games, SPECS, str(tmp_path / "rounds"), table, 5)
    rounds.summarise(START, last)
    assert len(written) > 1 and None not in written
    assert [d for some in written for d in some] == [START + n * DAY for n in (0, 1, 2, 4, 5, 6)]
    some = [START + n * DAY for n in (1, 2, 5)]
    rounds.summarise(some[0], some[-1], some)
    assert sorted(d for group in written[-2:] for d in group)[-1] == some[-1]
    found = sorted(rounds.summaries(START, last).collect(), key=str)
    assert found and found == sorted(once.summaries(START, last).collect(), key=str)
    rounds.summarise(START + 90 * DAY, START + 95 * DAY)
    assert sorted(rounds.summaries(START, last).collect(), key=str) == found
