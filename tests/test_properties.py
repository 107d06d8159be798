"""Operators against brute force on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from matchpeaks.metrics import MetricSpec
from matchpeaks.operators import assets, ingest, ranking, records, weekly

AS_OF = dt.date(2024, 1, 31)
TABLE = records.GameTable("player", "match", "champion", "ts")
quick = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

games = st.lists(
    st.tuples(
        st.sampled_from(["a", "a", "a", "b", "c"]),
        st.sampled_from(["X", "Y", None]),
        st.integers(min_value=-1, max_value=34),
        st.one_of(st.none(), st.integers(-3, 3)),
        st.one_of(st.none(), st.sampled_from([0.5, 1.5, -1.5, float("nan")])),
    ),
    max_size=40,
)


def stamp(days_back):
    return dt.datetime.combine(AS_OF, dt.time(13)) - dt.timedelta(days=days_back)


def brute_record(rows, player, column, better):
    def usable(low, high):
        return [
            r
            for r in rows
            if r["player"] == player
            and low <= (AS_OF - r["ts"].date()).days <= high
            and r[column] is not None
            and r[column] == r[column]
        ]

    today, history = usable(1, 1), usable(2, 32)
    if not today or not history:
        return None, None
    pick = max if better == "max" else min
    best = pick(r[column] for r in today)
    past = pick(r[column] for r in history)
    if not (best > past if better == "max" else best < past):
        return None, None
    game = min((r for r in today if r[column] == best), key=lambda r: r["match"])
    meta = None if game["champion"] is None else f"{game['match']}-_-{game['champion']}"
    return best, meta


@quick
@given(drawn=games)
def test_records(spark, drawn):
    rows = [
        {"player": p, "match": f"m{i:03d}", "champion": c, "ts": stamp(d), "high": h, "low": low}
        for i, (p, c, d, h, low) in enumerate(drawn)
    ]
    schema = "player string, match string, champion string, ts timestamp_ntz, high bigint, low double"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    roster = spark.createDataFrame([("a",), ("b",), ("z",)], "nickname string")
    specs = [MetricSpec("high"), MetricSpec("low", "min"), MetricSpec("low2", "max", "low")]
    measured = records.derived_metrics(
        df.withColumn("low2", F.col("low")), specs[:2], TABLE
    ).withColumn("low2", F.col("low"))
    found = records.record_detect(measured, roster, specs, AS_OF, table=TABLE).collect()
    assert sorted(r.source_nickname for r in found) == ["a", "b", "z"]
    for row in found:
        nick = row.source_nickname
        assert (row.high, row.high_meta) == brute_record(rows, nick, "high", "max")
        assert (row.low, row.low_meta) == brute_record(rows, nick, "low", "min")
        assert (row.low2, row.low2_meta) == brute_record(rows, nick, "low", "max")


@quick
@given(drawn=games)
def test_weekly_means(spark, drawn):
    rows = [(p, stamp(d), h) for p, _, d, h, _ in drawn]
    df = spark.createDataFrame(rows, "p string, ts timestamp_ntz, r bigint")
    roster = spark.createDataFrame([("a",), ("b",)], "nickname string")
    found = weekly.weekly_average(
        df, F.col("r").cast("double"), roster, AS_OF, weeks=3, player="p", time="ts"
    )
    monday = AS_OF - dt.timedelta(days=AS_OF.weekday())
    sums = {}
    for player, when, value in rows:
        day = when.date()
        if player in ("a", "b") and monday - dt.timedelta(days=21) <= day < monday:
            week = day - dt.timedelta(days=day.weekday())
            sums.setdefault((player, week), []).append(value)
    got = {(r.source_nickname, r.week_start): r.avg_kda for r in found.collect()}
    assert set(got) == set(sums)
    for key, values in sums.items():
        known = [v for v in values if v is not None]
        if not known:
            assert got[key] is None
        else:
            assert abs(got[key] - sum(known) / len(known)) <= 0.005 + 1e-9


@quick
@given(
    values=st.lists(st.tuples(st.sampled_from("hhhab"), st.integers(0, 9)), max_size=60),
    k=st.integers(1, 4),
)
def test_top_and_numbers(spark, values, k):
    rows = [(key, value, i) for i, (key, value) in enumerate(values)]
    df = spark.createDataFrame(rows, "key string, value int, i int").repartition(3)
    order = [F.col("value").desc(), F.col("i")]
    ranked = sorted(rows, key=lambda r: (-r[1], r[2]))
    expected = [r for n, r in enumerate(ranked) if sum(x[0] == r[0] for x in ranked[:n]) < k]
    found = ranking.top_per_group(df, ["key"], order, k)
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    numbered = ranking.number_rows(df, order).orderBy("pos").collect()
    assert [(r.key, r.value, r.i) for r in numbered] == ranked
    assert [r.pos for r in numbered] == list(range(1, len(rows) + 1))


@quick
@given(
    files=st.sets(st.tuples(st.sampled_from(["hot", "hot", "Lee Sin"]), st.integers(0, 40)), max_size=40),
    chunk=st.integers(1, 7),
)
def test_lists_hold_every_file_once(spark, files, chunk):
    rows = [(name, num, f"{name}_{num}.jpg") for name, num in files]
    df = spark.createDataFrame(rows, "champion string, num int, file string").repartition(3)
    lists = assets.collect_files(df, chunk).collect()
    assert all(0 < len(r.files) <= chunk for r in lists)
    together = {}
    for row in sorted(lists, key=lambda r: r.chunk):
        together.setdefault(row.champion, []).extend(row.files)
    for name, got in together.items():
        assert got == [f for n, _, f in sorted(rows, key=lambda r: r[1]) if n == name]
    assert sum(map(len, together.values())) == len(rows)


@quick
@given(
    landed=st.sets(st.tuples(st.sampled_from("ab"), st.integers(0, 9)), max_size=12),
    days=st.integers(1, 8),
)
def test_grid_minus_landed(spark, landed, days):
    roster = spark.createDataFrame([(1, "a"), (2, "c")], "roster_ord int, nickname string")
    rows = [(AS_OF - dt.timedelta(days=back), player) for player, back in landed]
    done = spark.createDataFrame(rows, "load_date date, player_key string")
    missing = ingest.missing_partitions(ingest.ingest_grid(roster, AS_OF, days), done)
    wanted = {(p, AS_OF - dt.timedelta(days=b)) for p in "ac" for b in range(1, days + 1)}
    assert {(r.nickname, r.load_date) for r in missing.collect()} == wanted - {
        (p, d) for d, p in rows
    }
