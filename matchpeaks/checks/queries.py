"""``queries()``: every operator of the library on the shared test tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..fixed_values import TEMPLATES
from ..functions import dates, text as tx, values as vl
from ..metrics import MetricSpec, match_metrics
from ..operators import assets, ingest, messages, ranking, records, sets, weekly
from ..plans import daily, increments
from ..schemas import PARTICIPANT
from ..sources import dimensions, matches, partitions, snapshots
from ..session import frees_disk, scratch_dir
from ..streaming import ingest as stream_ingest_job, triggers
from . import derived
from .derived import AS_OF, table

EVENTS = records.GameTable("user_id", "event_id", "event_type", "ts")
# Documents of one landed file at most, some 200 MB as plain text.
DOCUMENTS_A_FILE = 200_000
METRICS = [name for name, _ in TEMPLATES]
EVENT_TEXTS = [
    ("click", "{nickname}: {value} in {matchId} as {champion} ({value})"),
    ("error", "{champion} {value}"),
    ("purchase", "{nickname} paid {value}, see {matchId}"),
    ("signup", "{matchId}{nickname}"),
    ("view", "no values at all"),
]


def _double_decimals(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for comparing with another engine."""
    return df.withColumns(
        {
            field.name: F.col(field.name).cast("double")
            for field in df.schema.fields
            if isinstance(field.dataType, T.DecimalType)
        }
    )


# --- record detection -------------------------------------------------------


def _event_records(spark, sf_dir, specs):
    return records.record_detect(
        derived.events(spark, sf_dir),
        derived.event_roster(spark, sf_dir),
        specs,
        AS_OF,
        table=EVENTS,
        carry=("roster_ord",),
    )


def record_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_records(spark, sf_dir, [MetricSpec("value"), MetricSpec("k")])


def record_detect_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_records(spark, sf_dir, [MetricSpec("value", "min"), MetricSpec("k", "min")])


def _match_records(spark, sf_dir) -> DataFrame:
    specs = match_metrics()
    games = records.match_games(derived.own_participants(spark, sf_dir), specs)
    return records.record_detect(
        games, derived.roster(spark, sf_dir), specs, AS_OF, carry=("roster_ord",)
    )


def record_detect_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 43 metrics: the 87-column record table plus the roster order."""
    return _double_decimals(_match_records(spark, sf_dir))


def record_detect_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of ten successive days, each from that day's events and the stored window.

    The window is seven days long, so that the stacks are turned twice on the way.
    """
    root = scratch_dir(spark, "increments")
    games = derived.events(spark, sf_dir).withColumn("load_date", F.to_date("ts"))
    partitions.write_partitions(games.drop("props"), f"{root}/games", sort_by=("user_id",))
    by_day = dataclasses.replace(EVENTS, day="load_date", slack=0)
    specs = [MetricSpec("value"), MetricSpec("k", "min")]
    stored = spark.read.parquet(f"{root}/games")
    window = increments.RecordWindow(stored, specs, f"{root}/window", by_day, lookback_days=7)
    found = []
    for back in range(9, -1, -1):
        as_of = dt.date.fromisoformat(AS_OF) - dt.timedelta(days=back)
        rows = window.records(derived.event_roster(spark, sf_dir), as_of, ("roster_ord",))
        found.append(rows.withColumn("as_of", F.lit(as_of)))
    return functools.reduce(DataFrame.unionByName, found)


def today_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best game of the target day per user."""
    specs = [MetricSpec("value"), MetricSpec("k", "min")]
    found = records.today_metrics(derived.events(spark, sf_dir), specs, AS_OF, EVENTS)
    return found.select(
        "nickname",
        (-F.col("value.key")).alias("value"),
        F.col("value.match").alias("value_match"),
        F.col("value.champion").alias("value_champion"),
        F.col("k.key").alias("k"),
        F.col("k.match").alias("k_match"),
        F.col("k.champion").alias("k_champion"),
    )


def historical_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [MetricSpec("value"), MetricSpec("k", "min")]
    return records.historical_best(
        derived.events(spark, sf_dir), specs, AS_OF, lookback_days=7, table=EVENTS
    )


def own_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of both participants of each document, the tracked player's row."""
    return _participant_view(records.own_rows(_participants(spark, sf_dir)))


def derived_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = match_metrics()
    games = records.match_games(derived.own_participants(spark, sf_dir), specs)
    return _double_decimals(games)


def derived_metrics_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates per minute and in percent instead of truncated per-second ones."""
    specs = [
        spec
        for spec in match_metrics("real")
        if spec.name in ("cspm", "dpm", "gpm", "undying_ratio")
    ]
    games = records.match_games(derived.own_participants(spark, sf_dir), specs)
    return games.select(
        "source_nickname",
        "match_id",
        *[F.round(spec.name, 6).alias(spec.name) for spec in specs],
    )


def concat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model per table, put together by column name."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("nickname"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("nickname"))
    orders = records.GameTable("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    lines = records.GameTable("l_suppkey", "l_orderkey", "l_returnflag", "l_shipdate")
    models = [
        ("events", customers, "value", EVENTS, AS_OF),
        ("orders", customers, "o_totalprice", orders, "2001-07-01"),
        ("lineitem", suppliers, "l_extendedprice", lines, "2001-07-01"),
    ]
    found = []
    for name, roster, measure, columns, as_of in models:
        games = table(spark, sf_dir, name).withColumnRenamed(measure, "best")
        rows = records.record_detect(games, roster, [MetricSpec("best")], as_of, table=columns)
        found.append(rows.withColumn("model", F.lit(name)))
    return sets.concat_records(found)


# --- weekly averages --------------------------------------------------------


def weekly_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = F.col("value") / vl.at_least_one(F.col("k"))
    return weekly.weekly_average(
        derived.events(spark, sf_dir),
        ratio,
        derived.event_roster(spark, sf_dir),
        AS_OF,
        player="user_id",
        time="ts",
        result="avg_ratio",
    )


def weekly_avg_kda(spark: SparkSession, sf_dir: str) -> DataFrame:
    participants = derived.own_participants(spark, sf_dir)
    result = weekly.weekly_avg_kda(participants, derived.roster(spark, sf_dir), AS_OF)
    return weekly.order_weeks(result)


def weekly_avg_kda_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both participants of every document count."""
    return weekly.weekly_avg_kda(
        _participants(spark, sf_dir), derived.roster(spark, sf_dir), AS_OF
    )


def materialized_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly model as a catalog table, read in its order."""
    root = scratch_dir(spark, "weekly")
    name = "weekly_" + root.rsplit("-", 1)[-1]
    partitions.materialize_table(weekly_ratio(spark, sf_dir), name, root)
    return weekly.order_weeks(spark.table(name))


def materialized_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly model as a view of the session."""
    name = "weekly_view_" + scratch_dir(spark, "view").rsplit("-", 1)[-1]
    partitions.materialize_view(weekly_ratio(spark, sf_dir), name)
    return spark.table(name)


def _in_sequence(rows: DataFrame) -> DataFrame:
    """Numbers the rows in the order they come in."""
    placed = rows.withColumn("__place", F.monotonically_increasing_id())
    return ranking.number_rows(placed, [F.col("__place")]).drop("__place")


def ordered_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_sequence(weekly.order_weeks(weekly_ratio(spark, sf_dir)))


def ordered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = _in_sequence(messages.message_order(_messages(spark, sf_dir)))
    return ordered.select("pos", "source_nickname", "metric", "text")


def weekly_avg_kda_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each game's KDA rounded to one digit first, as exact decimals give it."""
    result = weekly.weekly_avg_kda(
        derived.own_participants(spark, sf_dir),
        derived.roster(spark, sf_dir),
        AS_OF,
        own_rows_only=True,
        decimal_scale=1,
    )
    return _double_decimals(result)


def roster_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order counts of the customers of one market segment."""
    segment = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price")
    )
    roster = segment.select(F.col("c_custkey").alias("nickname"))
    return records.in_roster(orders, roster, "o_custkey")


def for_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return records.for_player(parts, "Brand#17", "p_brand")


# --- messages ---------------------------------------------------------------


def _messages(spark, sf_dir) -> DataFrame:
    return messages.build_messages(_match_records(spark, sf_dir))


def unpivot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages.unpivot_records(_match_records(spark, sf_dir), METRICS)
    return messages.split_meta(rows)


def build_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.message_order(_messages(spark, sf_dir))


def cap_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a message row; k is the match, so most keys name several champions."""
    rows = derived.events(spark, sf_dir).select(
        F.col("user_id").alias("source_nickname"),
        F.lit("value").alias("metric"),
        F.col("k").alias("match_id"),
        F.concat_ws("_", "event_type", F.hour("ts")).alias("champion"),
        "event_id",
    )
    return messages.cap_in_order(rows, ("event_id",))


def number_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.number_messages(_messages(spark, sf_dir)).select(
        "pos", "total", "label", "source_nickname", "metric", "text"
    )


def number_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ranking.number_rows(orders, [F.col("o_orderdate"), F.col("o_orderkey")]).select(
        "o_orderkey", "pos", "total"
    )


def cap_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return ranking.top_per_group(orders, ["o_orderpriority"], order, 3, rank="place")


def limit_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    rows = orders.select("o_custkey", "year", "o_orderkey", "o_orderdate")
    return ingest.limit_per_day(rows, "o_custkey", "year", newest, 1).drop("o_orderdate")


def first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts", "k")
    order = [F.col("ts"), F.col("event_id")]
    return ranking.first_per_key(rows, ["user_id", "event_type"], order).drop("ts")


def message_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template, link and value text for every event."""
    rows = derived.events(spark, sf_dir).select(
        "event_id",
        F.col("event_type").alias("metric"),
        F.col("user_id").alias("source_nickname"),
        tx.value_text(F.col("value"), T.DoubleType()).alias("value"),
        tx.join_meta(F.concat(F.lit("RU_"), F.col("event_id")), F.col("event_type")).alias("meta"),
    )
    filled = messages.message_text(messages.split_meta(rows), EVENT_TEXTS)
    return filled.select("event_id", "match_id", "champion", "value", "text")


# --- ingest -----------------------------------------------------------------


def _parsed(spark, sf_dir) -> DataFrame:
    return matches.parse_matches(derived.documents(spark, sf_dir))


def _participant_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("`metadata.matchId`").alias("match_id"),
        F.col("`info.gameCreation`").alias("game_creation_ts"),
        F.col("`info.gameDuration`").alias("game_duration"),
        F.col("`participant.participantId`").alias("participant_id"),
        F.col("`participant.championName`").alias("champion_name"),
        F.col("`participant.kills`").alias("kills"),
        F.col("`participant.deaths`").alias("deaths"),
        F.col("`participant.goldEarned`").alias("gold_earned"),
        "source_nickname",
    )


def _participants(spark, sf_dir) -> DataFrame:
    documents = matches.valid_matches(_parsed(spark, sf_dir))
    rows = ingest.participants_of(documents, ("source_nickname", "load_date"))
    return ingest.add_source(rows, F.col("source_nickname"))


def explode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _participant_view(_participants(spark, sf_dir))


def rejected_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.rejected_matches(_parsed(spark, sf_dir)).select("event_id", "source_nickname")


def distinct_participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same participants landed twice collapse to one row each."""
    rows = derived.own_participants(spark, sf_dir)
    return _participant_view(ingest.distinct_participants(rows.unionByName(rows)))


def _land(documents: DataFrame, path: str, compression: str = "none") -> None:
    by_day = documents.select("text", "load_date").hint("rebalance", F.col("load_date"))
    by_day.write.partitionBy("load_date").text(path, compression=compression)


def _file(spark: SparkSession, sf_dir: str, path: str, **which) -> None:
    """Add documents to landing folders, as gzip: plain text would be most of all that the jobs write."""
    with frees_disk(spark):
        found = derived.documents(spark, sf_dir, DOCUMENTS_A_FILE, **which).select("text", "load_date")
        found.write.mode("append").partitionBy("load_date").text(path, compression="gzip")


def read_landed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as landed JSON files, read back through the source."""
    root = scratch_dir(spark, "landing")
    _land(derived.documents(spark, sf_dir), root)
    documents = matches.valid_matches(matches.read_matches(spark, root))
    rows = ingest.participants_of(documents, ("source_nickname",))
    return _participant_view(rows)


def drifted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kills as 5.0, as "5" and as "x": the first two are read, the third is rejected."""
    root = scratch_dir(spark, "landing")
    found = derived.documents(spark, sf_dir)
    text = F.col("text")
    for rest, kills in ((1, "$1.0"), (2, '"$1"'), (3, '"x"')):
        drifted = F.regexp_replace(text, r'(?<="kills":)(\d+)', kills)
        text = F.when(F.col("event_id") % 5 == rest, drifted).otherwise(text)
    _land(found.withColumn("text", text), root)
    documents = matches.valid_matches(matches.read_matches(spark, root))
    return _participant_view(ingest.participants_of(documents, ("source_nickname",)))


def ingest_grid_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = ingest.ingest_grid(derived.event_roster(spark, sf_dir), AS_OF)
    landed = derived.events(spark, sf_dir).select(
        F.to_date("ts").alias("load_date"), F.col("user_id").cast("string").alias("player_key")
    )
    missing = ingest.missing_partitions(grid, partitions.list_partitions(landed))
    return missing.select("roster_ord", "load_date", "player_key")


def json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = vl.parse_map(F.col("props"))
    return derived.events(spark, sf_dir).select(
        "event_id",
        vl.map_value(entries, "k").alias("k_value"),
        vl.map_value(entries, "absent").alias("absent_value"),
        F.size(entries).cast("bigint").alias("n_keys"),
        F.to_json(entries).alias("payload"),
    )


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drifted input: doubles for integers, a struct for a map, a missing column."""
    drifted = derived.events(spark, sf_dir).select(
        F.col("event_id").cast("double").alias("EVENT_ID"),
        F.struct(
            F.col("value").alias("value"),
            F.when(F.col("event_type") != "view", F.col("k").cast("double")).alias("k"),
        ).alias("challenges"),
        "user_id",
    )
    wanted = T.StructType.fromDDL(
        "event_id bigint, challenges map<string,double>, missions map<string,bigint>, user_id bigint"
    )
    rows = matches.conform_schema(drifted, wanted)
    return rows.select(
        "event_id",
        vl.map_value(F.col("challenges"), "value").alias("value"),
        vl.map_value(F.col("challenges"), "k").alias("k"),
        F.size("challenges").cast("bigint").alias("n_keys"),
        F.col("missions").isNull().alias("no_missions"),
        "user_id",
    )


def nested_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map and nested columns of a participant: kept as they are, and addressed."""
    selections = F.array(F.struct(F.col("event_id").alias("perk")), F.struct(F.col("k").alias("perk")))
    style = F.struct(F.col("user_id").alias("style"), selections.alias("selections"))
    perks = F.struct(
        F.struct(F.col("k").alias("offense")).alias("statPerks"), F.array(style).alias("styles")
    )
    text = F.to_json(
        F.struct(
            F.create_map(F.lit("value"), F.col("value")).alias("challenges"),
            F.create_map(F.col("event_type"), F.col("k")).alias("missions"),
            perks.alias("perks"),
        )
    )
    parsed = F.inline(F.array(vl.parse_document(text, PARTICIPANT)))
    styles = (
        derived.events(spark, sf_dir)
        .select("event_id", parsed)
        .select(
            "event_id",
            F.col("perks.statPerks.offense").alias("offense"),
            vl.map_value(F.col("challenges"), "value").alias("challenge"),
            vl.map_value(F.col("missions"), "click").alias("click_mission"),
            F.explode("perks.styles").alias("s"),
        )
    )
    return styles.select("*", F.col("s.style").alias("style"), F.inline("s.selections")).drop(
        "s", "var1", "var2", "var3"
    )


def select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated columns dropped, then a projected read."""
    orders = table(spark, sf_dir, "orders")
    doubled = orders.select("o_orderkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    unique = matches.drop_duplicate_columns(doubled)
    return matches.select_columns(unique, ["o_orderkey", "o_totalprice"])


# --- dates, text, numbers ---------------------------------------------------


def day_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.events(spark, sf_dir).select(
        "event_id",
        F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("ms"),
    )
    day = dates.game_date(rows, "ms")
    start, end = dates.day_bounds_seconds(day)
    target = dates.target_day(AS_OF)
    return rows.select(
        "event_id",
        "ms",
        day.alias("day"),
        dates.iso_date(day).alias("day_text"),
        start.alias("start_s"),
        end.alias("end_s"),
        dates.in_days(rows, "ms", target, target).alias("is_target"),
        dates.in_days(rows, "ms", *dates.history_days(AS_OF)).alias("in_history"),
    )


def week_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.events(spark, sf_dir).select("event_id", "ts")
    day = dates.game_date(rows, "ts")
    return rows.select(
        "event_id",
        dates.week_start(day).alias("week_start"),
        dates.in_days(rows, "ts", *dates.full_weeks(AS_OF)).alias("in_full_weeks"),
    )


def number_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    number = F.col("l_linenumber").cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        vl.truncated_ratio(quantity, number - 1).alias("per_line"),
        vl.at_least_one(number - 3).alias("at_least_one"),
        vl.count_if_id(number, 4, quantity).alias("line4_quantity"),
        tx.value_text(F.col("l_extendedprice"), T.DoubleType()).alias("price_text"),
        tx.has_value(F.col("l_discount"), T.DoubleType()).alias("discounted"),
    )


def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    isolated = F.concat(F.lit("⁦"), F.col("p_name"), F.lit("⁩#"), F.col("p_brand"))
    rows = table(spark, sf_dir, "part").withColumn("player", isolated)
    plain = tx.strip_isolates(F.col("player"))
    return rows.select(
        "p_partkey",
        plain.alias("plain"),
        tx.is_player_id(F.col("p_type")).alias("type_is_id"),
        tx.path_key(F.col("player")).alias("path_key"),
        tx.player_name(plain).alias("name"),
        tx.player_tag(plain).alias("tag"),
        tx.player_tag(F.col("p_type")).alias("no_tag"),
        tx.percent_encode(plain).alias("encoded"),
        tx.normalised_key(F.col("p_name")).alias("name_key"),
        tx.landing_path("stage", F.to_date(F.lit("2024-01-30")), F.col("player")).alias("path"),
        tx.own_row(plain, F.col("p_name"), F.col("p_brand")).alias("own"),
        tx.player_link(plain).alias("link"),
    )


# --- assets -----------------------------------------------------------------


def _part_files(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("champion"),
        F.col("p_partkey").alias("num"),
        F.concat(F.col("p_name"), F.lit("_"), F.col("p_partkey"), F.lit(".jpg")).alias("file"),
    )


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = assets.collect_files(_part_files(spark, sf_dir))
    return lists.select("champion", "chunk", F.to_json("files").alias("files"))


def _manifest(spark, sf_dir) -> DataFrame:
    lists = assets.collect_files(_part_files(spark, sf_dir))
    return dimensions.manifest_rows(assets.manifest_json(lists), "/splashes")


def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists written as JSON and taken apart again."""
    return _manifest(spark, sf_dir).select("champion", "champ_norm", "file")


def skin_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.create_map(
        F.col("p_brand"),
        F.struct(
            F.array(
                F.struct(F.col("p_partkey").cast("int").alias("num")),
                F.struct(F.col("p_size").alias("num")),
            ).alias("skins")
        ),
    )
    nested = F.from_json(F.to_json(data), "map<string,struct<skins:array<struct<num:int>>>>")
    return assets.skin_files(table(spark, sf_dir, "part").select(nested.alias("data")))


def pick_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _part_files(spark, sf_dir).select(
        tx.normalised_key(F.col("champion")).alias("champ_norm"), F.col("num").alias("pos"), "file"
    )
    return assets.pick_random(files, seed=7)


def directory_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _part_files(spark, sf_dir).select("file")
    return assets.directory_manifest(files).drop("pos")


def manifest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item's brand looked up among the picks; two brands have none."""
    files = _part_files(spark, sf_dir).where(~F.col("champion").isin("Brand#1", "Brand#2"))
    keyed = files.select(
        tx.normalised_key(F.col("champion")).alias("champ_norm"), F.col("num").alias("pos"), "file"
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return assets.manifest_join(parts, assets.pick_random(keyed, seed=7), "p_brand")


def prune_unlisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = table(spark, sf_dir, "documents").select("doc_id", "source")
    return assets.prune_unlisted(present, table(spark, sf_dir, "labels"), "doc_id")


# --- tables and snapshots ---------------------------------------------------


def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write by day, register the folders in the catalog, read the table."""
    root = scratch_dir(spark, "partitions")
    name = "matches_" + root.rsplit("-", 1)[-1]
    rows = derived.events(spark, sf_dir).select(
        "event_id",
        "event_type",
        "value",
        F.col("user_id").cast("string").alias("player_key"),
        F.to_date("ts").alias("load_date"),
    )
    partitions.write_partitions(rows, root)
    spark.sql(
        f"CREATE TABLE {name} (event_id bigint, event_type string, value double, "
        f"player_key string, load_date date) USING parquet "
        f"PARTITIONED BY (load_date) LOCATION '{root}'"
    )
    partitions.register_all(spark, name)
    return spark.table(name)


def participant_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog table of participants, created first and filled afterwards."""
    root = scratch_dir(spark, "participants")
    name = "participants_" + root.rsplit("-", 1)[-1]
    matches.create_participant_table(spark, name, root)
    partitions.write_partitions(partitions.with_player_key(_participants(spark, sf_dir)), root)
    partitions.register_all(spark, name)
    return _participant_view(spark.table(name))


def list_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "partitions")
    rows = derived.events(spark, sf_dir).select(
        "event_id",
        F.col("user_id").cast("string").alias("player_key"),
        F.to_date("ts").alias("load_date"),
    )
    partitions.write_partitions(rows, root)
    return partitions.list_partitions(partitions.read_partitions(spark, root))


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First call stores the records, the second serves them."""
    root = scratch_dir(spark, "snapshot")

    def compute() -> DataFrame:
        return record_detect(spark, sf_dir)

    snapshots.load_snapshot(spark, root, compute)
    return snapshots.load_snapshot(spark, root, compute)


def snapshot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted while snapshots were written."""
    root = scratch_dir(spark, "snapshot")
    for name in ("events", "orders"):
        snapshots.write_snapshot(table(spark, sf_dir, name), root)
    commits = spark.read.schema(snapshots.COMMIT_SCHEMA).json(f"{root}/commits")
    return commits.select("seq", "written_rows")


def snapshot_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a caller is served: first, when too old, after that, without old results, and forced."""
    root = scratch_dir(spark, "snapshot")
    served = []
    calls = ({}, {"max_age_seconds": -1}, {}, {"max_age_seconds": -1, "serve_stale": False}, {"force": True})
    for step, options in enumerate(calls):
        rows = derived.events(spark, sf_dir).where(F.col("event_id") % (step + 1) == 0).select("event_id")
        found = snapshots.load_snapshot(spark, root, lambda rows=rows: rows, **options)
        snapshots.wait_for_refresh(root)
        served.append(found.select(F.lit(step).alias("step"), "event_id"))
    return functools.reduce(DataFrame.unionAll, served)


# --- streams ----------------------------------------------------------------


def _trigger_stream(spark, sf_dir, root, files_per_batch=1000) -> DataFrame:
    """Every event as a trigger message, each sent twice."""
    sent = derived.events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("msg_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("props").alias("payload"),
    )
    for _ in range(2):
        triggers.publish_trigger(sent.repartition(4, F.xxhash64("msg_id")), f"{root}/in")
    return triggers.read_triggers(spark, f"{root}/in", files_per_batch)


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that were handled: each id once, in batches that go back and forth in time."""
    root = scratch_dir(spark, "stream")
    stream = triggers.dedupe_triggers(_trigger_stream(spark, sf_dir, root, files_per_batch=4))
    query = triggers.on_trigger(stream, lambda batch, _: None, f"{root}/at", f"{root}/done")
    query.awaitTermination()
    return spark.read.parquet(f"{root}/done").select(
        F.col("msg_id").cast("bigint").alias("event_id"), F.col("payload").alias("props")
    )


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that stops and starts again goes on where it stood."""
    root = scratch_dir(spark, "stream")
    sent = derived.events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("msg_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("props").alias("payload"),
    )
    odd = F.col("msg_id").cast("bigint") % 2 == 1
    for part in (sent.where(~odd), sent.where(odd), None):
        if part is not None:
            triggers.publish_trigger(part, f"{root}/in")
        stream = triggers.read_triggers(spark, f"{root}/in")
        triggers.on_trigger(stream, lambda batch, _: None, f"{root}/at", f"{root}/done").awaitTermination()
    return spark.read.parquet(f"{root}/done").select(
        F.col("msg_id").cast("bigint").alias("event_id"), "batch_id"
    )


def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as the last trigger left them."""
    root = scratch_dir(spark, "stream")

    def refresh(batch: DataFrame, batch_id: int) -> None:
        snapshots.write_snapshot(record_detect(spark, sf_dir), f"{root}/records")

    stream = _trigger_stream(spark, sf_dir, root)
    triggers.on_trigger(stream, refresh, f"{root}/at").awaitTermination()
    return snapshots.read_snapshot(spark, f"{root}/records")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participant rows of all landed documents, ingested in several batches."""
    root = scratch_dir(spark, "stream")
    # As plain text the landed files are more than half of all that the job writes.
    _land(derived.documents(spark, sf_dir), f"{root}/landing", compression="lz4")
    documents = stream_ingest_job.stream_matches(spark, f"{root}/landing", files_per_batch=16)
    query = stream_ingest_job.ingest_stream(documents, f"{root}/table", f"{root}/at", compact_every=2)
    query.awaitTermination()
    return _participant_view(stream_ingest_job.streamed_table(spark, f"{root}/table").read())


# --- daily jobs -------------------------------------------------------------


def daily_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing, ingest, records and messages with images in one go, through the catalog table."""
    root = scratch_dir(spark, "daily")
    name = "participants_" + root.rsplit("-", 1)[-1]
    places = daily.Places(root, table=name, images=f"{root}/images")
    champions = derived.events(spark, sf_dir).select("event_type").distinct()
    listed = F.array(F.concat("event_type", F.lit(".jpg")))
    shown = champions.where("event_type <> 'view'").select(F.to_json(F.create_map("event_type", listed)))
    shown.write.text(places.images)
    _file(spark, sf_dir, places.landing)
    roster = derived.roster(spark, sf_dir)
    as_of = dt.date.fromisoformat(AS_OF)
    daily.daily_ingest(spark, places, roster, as_of, days=32)
    return daily.current_messages(spark, places, roster, as_of).drop("roster_ord", "metric_ord")


def daily_window_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the stored window: a third of the documents land two days before, the rest on the day.

    So most days of the window get rows after the window has taken them in.
    """
    places = daily.Places(scratch_dir(spark, "daily"))
    roster = derived.roster(spark, sf_dir)
    as_of = dt.date.fromisoformat(AS_OF)
    early = as_of - dt.timedelta(days=2)
    _file(spark, sf_dir, places.landing, where="event_id % 3 = 0")
    daily.daily_ingest(spark, places, roster, early, days=32)
    daily.update_records(spark, places, roster, early)
    _file(spark, sf_dir, places.landing, where="event_id % 3 <> 0")
    late = daily.daily_ingest(spark, places, roster, as_of, days=32)
    return _double_decimals(daily.update_records(spark, places, roster, as_of, late_days=late))


def daily_late_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that land after others of their player-day, and in a later folder, are loaded.

    A third of them land for the first run; the second finds all, three days later.
    """
    places = daily.Places(scratch_dir(spark, "daily"))
    roster = derived.roster(spark, sf_dir)
    as_of = dt.date.fromisoformat(AS_OF)
    _file(spark, sf_dir, places.landing, where="event_id % 3 = 0")
    daily.daily_ingest(spark, places, roster, as_of, days=32)
    _file(spark, sf_dir, f"{places.root}/late", days_later=3)
    late = daily.Places(places.root, landing_folder="late")
    for _ in range(2):
        daily.daily_ingest(spark, late, roster, as_of + dt.timedelta(days=4), days=36)
    return _participant_view(daily.read_table(spark, places))


def stream_ingest_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document lands twice, in files of different batches."""
    root = scratch_dir(spark, "stream")
    for _ in range(2):
        _file(spark, sf_dir, f"{root}/landing")
    documents = stream_ingest_job.stream_matches(spark, f"{root}/landing", files_per_batch=16)
    stream_ingest_job.ingest_stream(documents, f"{root}/table", f"{root}/at").awaitTermination()
    return _participant_view(stream_ingest_job.streamed_table(spark, f"{root}/table").read())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        record_detect,
        record_detect_min,
        record_detect_matches,
        record_detect_incremental,
        today_metrics,
        historical_best,
        own_rows,
        derived_metrics,
        derived_metrics_real,
        concat_records,
        weekly_ratio,
        weekly_avg_kda,
        weekly_avg_kda_all_rows,
        weekly_avg_kda_decimal,
        materialized_weekly,
        materialized_view,
        ordered_weeks,
        ordered_messages,
        roster_semi,
        for_player,
        unpivot_records,
        build_messages,
        cap_in_order,
        number_messages,
        number_rows,
        cap_per_group,
        limit_per_group,
        first_occurrence,
        message_text,
        explode_nested,
        rejected_matches,
        distinct_participants,
        read_landed_matches,
        drifted_documents,
        ingest_grid_missing,
        json_map,
        conform_schema,
        nested_columns,
        select_columns,
        day_bounds,
        week_bounds,
        number_functions,
        text_keys,
        manifest_files,
        manifest_rows,
        skin_files,
        pick_random,
        directory_manifest,
        manifest_join,
        prune_unlisted,
        partition_roundtrip,
        participant_table,
        list_partitions,
        snapshot_roundtrip,
        snapshot_counts,
        snapshot_branches,
        stream_dedupe,
        stream_restart,
        stream_refresh,
        stream_ingest,
        stream_ingest_repeats,
        daily_messages,
        daily_window_records,
        daily_late_matches,
    ]
    return {query.__name__: query for query in listed}
