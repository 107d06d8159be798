import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from matchpeaks.functions import dates, text as tx, values as vl
from urllib.parse import quote


@pytest.mark.parametrize(
    "day, monday",
    [
        ("2024-01-29", "2024-01-29"),
        ("2024-01-28", "2024-01-22"),
        ("2024-02-29", "2024-02-26"),
    ],
)
def test_week_start(one, day, monday):
    assert one(dates.week_start(F.lit(day).cast("date"))) == dt.date.fromisoformat(monday)


def test_windows(one):
    first, last = dates.history_days("2024-01-31")
    assert one(dates.target_day("2024-01-31")) == dt.date(2024, 1, 30)
    assert (one(first), one(last)) == (dt.date(2023, 12, 30), dt.date(2024, 1, 29))
    first, last = dates.full_weeks("2024-01-31")
    assert (one(first), one(last)) == (dt.date(2023, 12, 25), dt.date(2024, 1, 28))
    days = one(dates.ingest_days("2024-01-31"))
    assert days == [dt.date(2024, 1, day) for day in range(24, 31)]


def test_default_as_of_is_today(one):
    assert one(dates.target_day()) == one(F.date_sub(F.current_date(), 1))


def test_in_days_keeps_the_edges(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 23:30 and 00:30 Berlin time lie on different days there, not in UTC.
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        late, early = 1706653800000, 1706657400000
        rows = spark.createDataFrame([(late,), (early,)], "ms bigint")
        day = F.lit("2024-01-30").cast("date")
        kept = rows.where(dates.in_days(rows, "ms", day, day)).collect()
        assert [row.ms for row in kept] == [late]
        by_date = rows.where(dates.game_date(rows, "ms") == day).collect()
        assert by_date == kept
        # The day the clocks change has 23 hours.
        start, end = dates.day_bounds_seconds(F.lit("2024-03-31").cast("date"))
        row = spark.range(1).select((end - start).alias("s")).first()
        assert row.s == 23 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ids(one):
    player = F.lit("⁦Al pha#T1⁩")
    assert one(tx.strip_isolates(player)) == "Al pha#T1"
    assert one(tx.path_key(player)) == "Al pha_T1"
    assert one(tx.player_name(F.lit("a#b#c"))) == "a"
    assert one(tx.player_tag(F.lit("a#b#c"))) == "b#c"
    assert one(tx.player_tag(F.lit("abc"))) is None
    assert one(tx.is_player_id(F.lit("abc"))) is False
    assert one(tx.own_row(F.lit("a#b"), F.lit("a"), F.lit("b"))) is True
    assert one(tx.own_row(F.lit("a#b"), F.lit(None), F.lit("b"))) is None
    path = tx.landing_path("stage", F.lit("2024-01-30").cast("date"), player)
    assert one(path) == "stage/2024-01-30/Al pha_T1"


@pytest.mark.parametrize("name", ["a b#c", "Бета/x~y*z", "1+1=2&3", "plain-_.", "é ü"])
def test_percent_encode_equals_url_quoting(one, name):
    assert one(tx.percent_encode(F.lit(name))) == quote(name)


def test_normalised_key(one):
    assert one(tx.normalised_key(F.lit("Lee_Sin -  \x1fX"))) == "leesinx"


@pytest.mark.parametrize(
    "meta, match, champion",
    [
        ("RU_1-_-Ahri", "RU_1", "Ahri"),
        ("RU_1-_-A-_-B", "RU_1", "A-_-B"),
        ("RU_1", "RU_1", "<champion>"),
        ("-_-Ahri", "<match>", "Ahri"),
        ("RU_1-_-", "RU_1", "<champion>"),
        ("", "<match>", "<champion>"),
        (None, "<match>", "<champion>"),
    ],
)
def test_split_meta(one, meta, match, champion):
    column = F.lit(meta).cast("string")
    assert one(tx.meta_match(column)) == match
    assert one(tx.meta_champion(column)) == champion


def test_join_meta_is_null_with_a_null_side(one):
    assert one(tx.join_meta(F.lit("m"), F.lit("c"))) == "m-_-c"
    assert one(tx.join_meta(F.lit("m"), F.lit(None))) is None


def test_link_drops_only_a_prefix(one):
    assert one(tx.match_link(F.lit("RU_12"), "%s|%s")) == "12|RU_12"
    assert one(tx.match_link(F.lit("X_RU_12"), "%s|%s")) == "X_RU_12|X_RU_12"


def test_template_values_are_not_searched_again(one):
    parts = tx.template_parts(F.lit("{a}: {b}! {c}{a}"))
    filled = tx.fill_template(parts, {"a": F.lit("{b}"), "b": F.lit("{a}")})
    assert one(filled) == "{b}: {a}! {c}{b}"


@pytest.mark.parametrize(
    "value",
    [1.5, 12.0, 0.1, 12345678.25, 1e-5, 2.5e-7, 0.0001, -3.25, 1e15, 9007199254740991.0, 1 / 3],
)
def test_value_text_equals_python(one, value):
    expected = str(int(value)) if value.is_integer() else str(value)
    assert one(tx.value_text(F.lit(value), T.DoubleType())) == expected


def test_value_text_of_other_types(one):
    assert one(tx.value_text(F.lit(7), T.LongType())) == "7"
    assert one(tx.value_text(F.lit(True), T.BooleanType())) == "True"
    assert one(tx.value_text(F.lit("8.0").cast("decimal(22,1)"), T.DecimalType(22, 1))) == "8.0"
    assert one(tx.value_text(F.lit(float("inf")), T.DoubleType())) == "inf"


@pytest.mark.parametrize(
    "value, kind, kept",
    [
        (None, "double", False),
        (0.0, "double", False),
        (float("nan"), "double", False),
        (-1.0, "double", True),
        (0, "bigint", False),
        (False, "boolean", False),
        (None, "boolean", False),
        (True, "boolean", True),
        ("", "string", False),
        ("0", "string", False),
        ("00", "string", True),
    ],
)
def test_has_value(spark, value, kind, kept):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    column = tx.has_value(F.col("v"), df.schema["v"].dataType)
    assert bool(df.select(column.alias("x")).first()["x"]) is kept


def test_numbers(one):
    assert one(vl.truncated_ratio(F.lit(-7), F.lit(2))) == -3
    assert one(vl.truncated_ratio(F.lit(7), F.lit(0))) is None
    assert one(vl.at_least_one(F.lit(0))) == 1
    assert one(vl.at_least_one(F.lit(None).cast("int"))) is None
    assert one(vl.count_if_id(F.lit(4), 4, F.lit(9))) == 9
    assert one(vl.count_if_id(F.lit(None).cast("int"), 4, F.lit(9))) == 0


def test_json_and_maps(one):
    parsed = vl.parse_document(F.lit('{"a": 1'), "a bigint")
    assert one(parsed.getField("a")) is None
    entries = vl.parse_map(F.lit('{"a": 1}'))
    assert one(vl.map_value(entries, "a")) == 1
    assert one(vl.map_value(entries, "b")) is None
