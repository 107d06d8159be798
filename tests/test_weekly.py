import datetime as dt

from pyspark.sql import functions as F

from matchpeaks.operators import weekly

AS_OF = "2024-01-31"


def run(spark, rows, **options):
    games = spark.createDataFrame(
        rows,
        "source_nickname string, `info.gameCreation` bigint, `participant.kills` bigint, "
        "`participant.assists` bigint, `participant.deaths` bigint, "
        "`participant.riotIdGameName` string, `participant.riotIdTagline` string",
    )
    roster = spark.createDataFrame([("a#1",), ("a#1",), ("b#1",)], "nickname string")
    result = weekly.weekly_avg_kda(games, roster, AS_OF, **options)
    return [(r.source_nickname, str(r.week_start), r.avg_kda) for r in weekly.order_weeks(result).collect()]


def game(day, kills, deaths, player="a#1", name="a", assists=0):
    stamp = dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc)
    return (player, int(stamp.timestamp() * 1000), kills, assists, deaths, name, "1")


def test_week_edges_and_roster(spark):
    rows = [
        game("2024-01-29", 100, 1),  # current week
        game("2024-01-28T23:59:59", 3, 2),
        game("2024-01-22", 4, 0),
        game("2024-01-21T23:59:59", 8, 3),
        game("2023-12-25", 5, 5),
        game("2023-12-24T23:59:59", 100, 1),  # before the five weeks
        game("2024-01-22", 9, 1, "stranger#1"),
    ]
    assert run(spark, rows) == [
        ("a#1", "2024-01-22", 2.75),
        ("a#1", "2024-01-15", 2.67),
        ("a#1", "2023-12-25", 1.0),
    ]


def test_null_deaths_do_not_count(spark):
    rows = [game("2024-01-22", 4, None), game("2024-01-23", 6, 2)]
    assert run(spark, rows) == [("a#1", "2024-01-22", 3.0)]


def test_all_participants_or_own_rows(spark):
    rows = [game("2024-01-22", 4, 1), game("2024-01-22", 8, 1, name="other")]
    assert run(spark, rows)[0][2] == 6.0
    assert run(spark, rows, own_rows_only=True)[0][2] == 4.0


def test_decimal_scale_rounds_games_and_mean(spark):
    # 1/3 → 0.3, 1/4 → 0.3 (half up), 2/1: mean of tenths 26/30 → 0.9
    rows = [game("2024-01-22", 1, 3), game("2024-01-22", 1, 4), game("2024-01-22", 2, 1)]
    assert str(run(spark, rows, decimal_scale=1)[0][2]) == "0.9"
    # 0.1 and 0.2 average to 0.15, which rounds up to 0.2
    rows = [game("2024-01-22", 1, 10), game("2024-01-22", 1, 5)]
    assert str(run(spark, rows, decimal_scale=1)[0][2]) == "0.2"


def test_negative_ratios_round_away_from_zero(spark):
    rows = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 22), -0.1), ("a", dt.datetime(2024, 1, 22), -0.2)],
        "p string, ts timestamp_ntz, r double",
    )
    roster = spark.createDataFrame([("a",)], "nickname string")
    found = weekly.weekly_average(
        rows, F.col("r"), roster, AS_OF, player="p", time="ts", decimal_scale=1
    )
    assert str(found.first().avg_kda) == "-0.2"
