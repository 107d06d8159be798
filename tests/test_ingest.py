import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F, types as T

from matchpeaks.fixed_values import META_COLUMNS
from matchpeaks.operators import ingest
from matchpeaks.plans import daily
from matchpeaks.schemas import MATCH, RAW
from matchpeaks.session import FREE_SHUFFLES, cut_lineage, frees_disk, scratch_root
from matchpeaks.sources import matches, partitions, snapshots
from matchpeaks.sources.dimensions import read_roster, roster_of
from matchpeaks.streaming import triggers

DAY = dt.date(2024, 1, 30)


def document(match="RU_1", participants=None, drop=(), created="2024-01-30T12:00:00", **info):
    stamp = dt.datetime.fromisoformat(created).replace(tzinfo=dt.timezone.utc)
    body = {
        "gameCreation": int(stamp.timestamp() * 1000),
        "gameDuration": 1800,
        "gameMode": "CLASSIC",
        "queueId": 420,
        "gameVersion": "14.1",
        "participants": [{"participantId": 1}] if participants is None else participants,
        **info,
    }
    for name in drop:
        body.pop(name)
    return {"metadata": {"matchId": match}, "info": body}


def land(folder, day, player, documents):
    target = folder / f"load_date={day}" / f"source_nickname={player.replace('#', '%23')}"
    target.mkdir(parents=True, exist_ok=True)
    lines = [d if isinstance(d, str) else json.dumps(d, ensure_ascii=False) for d in documents]
    (target / f"{len(list(target.iterdir()))}.json").write_text("\n".join(lines), encoding="utf-8")


def test_valid_and_rejected_documents(spark, tmp_path):
    bad = [document(f"bad_{name}", drop=(name,)) for name in ("gameMode", "queueId")]
    bad += [{"metadata": {"matchId": "x"}}, {"info": document()["info"]}, '{"metadata": {"matc']
    land(tmp_path, DAY, "Alpha#T1", [document("RU_1"), document("RU_2", []), *bad])
    documents = matches.read_matches(spark, str(tmp_path))
    valid = matches.valid_matches(documents)
    assert sorted(r.metadata.matchId for r in valid.collect()) == ["RU_1", "RU_2"]
    rejected = matches.rejected_matches(documents).collect()
    assert len(rejected) == 5
    assert sum(r[matches.CORRUPT] is not None for r in rejected) == 1
    assert {r.source_nickname for r in rejected} == {"Alpha#T1"}


def test_drifted_numbers(spark, tmp_path):
    people = [{"kills": 5.0, "deaths": "7", "missions": {"x": 2.0}, "riotIdTagline": "12", "lane": "x: 5.0"}]
    kept = [document("RU_1", people), document("RU_2", [{"kills": 3}])]
    bad = [document("RU_3", [{"kills": "x"}]), document("RU_4", [{"missions": {"x": 1.5}}])]
    land(tmp_path, DAY, "Alpha#T1", [*kept, *bad])
    documents = matches.read_matches(spark, str(tmp_path))
    rows = {r.metadata.matchId: r for r in matches.valid_matches(documents).collect()}
    assert sorted(rows) == ["RU_1", "RU_2"]
    player = rows["RU_1"].info.participants[0]
    assert (player.kills, player.deaths, player.missions, player.lane) == (5, 7, {"x": 2}, "x: 5.0")
    assert player.riotIdTagline == "12" and rows["RU_1"].source_nickname == "Alpha#T1"
    assert matches.rejected_matches(documents).count() == 2


def test_one_document_per_file(spark, tmp_path):
    target = tmp_path / f"load_date={DAY}"
    target.mkdir()
    body = {**document(), "source_nickname": "007"}
    (target / "a.json").write_text(json.dumps(body, indent=2))
    row = matches.read_matches(spark, str(tmp_path), one_per_file=True).first()
    assert (row.metadata.matchId, row.source_nickname, row.load_date) == ("RU_1", "007", DAY)


def test_explode_keeps_nested_values_and_nulls(spark, tmp_path):
    people = [
        {
            "participantId": 1,
            "kills": 5,
            "win": True,
            "challenges": {"a": 1.5},
            "missions": {"m": 2},
            "perks": {"statPerks": {"offense": 9}, "styles": [{"style": 1, "selections": [{"perk": 3}]}]},
        },
        {"participantId": 2},
    ]
    land(tmp_path, DAY, "Alpha#T1", [document("RU_1", people), document("RU_2", [])])
    documents = matches.valid_matches(matches.read_matches(spark, str(tmp_path)))
    rows = ingest.participants_of(documents, ("source_nickname",))
    assert rows.columns == RAW.fieldNames()
    assert rows.schema["participant.kills"].dataType == T.LongType()
    first, second = rows.orderBy("`participant.participantId`").collect()
    assert first["participant.challenges"] == {"a": 1.5}
    assert first["participant.perks"].styles[0].selections[0].perk == 3
    offense = rows.select(F.col("`participant.perks`.statPerks.offense").alias("o")).collect()
    assert sorted(r.o or 0 for r in offense) == [0, 9]
    assert second["participant.kills"] is None
    assert [first[name] for name, _ in META_COLUMNS][0] == "RU_1"


def test_text_column_is_parsed_once(spark):
    df = spark.createDataFrame([(json.dumps(document()),), ("{",)], "text string")
    valid = matches.valid_matches(matches.parse_matches(df))
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert valid.count() == 1
    rejected = matches.rejected_matches(matches.parse_matches(df)).first()
    assert rejected[matches.CORRUPT] == "{"


def test_conform_schema(spark):
    drifted = spark.createDataFrame(
        [(1.0, (1.5, None), "x", 3)],
        "`participant.KILLS` double, `participant.challenges` struct<a:double,b:double>, "
        "`participant.lane` string, `Unnamed: 0` int",
    )
    row = matches.conform_schema(drifted, RAW).first()
    assert len(row) == len(RAW.fields)
    assert row["participant.kills"] == 1 and isinstance(row["participant.kills"], int)
    assert row["participant.challenges"] == {"a": 1.5}
    assert row["participant.perks"] is None


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "a.b", "a")
    unique = matches.drop_duplicate_columns(df)
    assert unique.columns == ["a", "a.b"] and unique.first()["a"] == 1
    assert matches.select_columns(unique, ["a.b"]).columns == ["a.b"]


def test_grid_and_missing(spark):
    roster = roster_of(spark, ["Alpha#T1", "⁦Бета#T1⁩"])
    grid = ingest.ingest_grid(roster, "2024-01-31")
    assert grid.count() == 14
    landed = spark.createDataFrame([(DAY, "Бета_T1")], "load_date date, player_key string")
    missing = ingest.missing_partitions(grid, landed)
    assert missing.count() == 13
    assert missing.where("player_key = 'Alpha_T1'").count() == 7


def test_limit_per_day(spark):
    rows = spark.range(250).select(
        F.lit("a").alias("source_nickname"),
        F.lit(DAY).alias("load_date"),
        F.col("id").alias("info.gameCreation"),
        F.col("id").cast("string").alias("metadata.matchId"),
    )
    kept = ingest.limit_per_day(rows)
    assert kept.count() == 100
    assert kept.agg(F.min("`info.gameCreation`")).first()[0] == 150


def test_distinct_participants(spark):
    row = {name: None for name in RAW.fieldNames()}
    row.update({"source_nickname": "a", "metadata.matchId": "RU_1", "participant.participantId": 1})
    other = {**row, "source_nickname": "b"}
    data = [tuple(r[n] for n in RAW.fieldNames()) for r in (row, row, other)]
    assert ingest.distinct_participants(spark.createDataFrame(data, RAW)).count() == 2


@pytest.mark.parametrize("layout", [partitions.DAY_LAYOUT, partitions.PLAYER_DAY_LAYOUT])
def test_partition_layouts(spark, tmp_path, layout):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame(
        [("Alpha#T1", DAY, 1), ("Бета#T1", DAY, 2), ("Alpha#T1", dt.date(2024, 1, 29), 3)],
        "source_nickname string, load_date date, v int",
    )
    keyed = partitions.with_player_key(rows)
    partitions.write_partitions(keyed, path, layout)
    back = partitions.read_partitions(spark, path)
    assert sorted(r.v for r in back.collect()) == [1, 2, 3]
    assert partitions.list_partitions(back).count() == 3
    # Replacing one day leaves the others alone.
    partitions.write_partitions(keyed.where("v = 3"), path, layout, mode="overwrite")
    assert sorted(r.v for r in partitions.read_partitions(spark, path).collect()) == [1, 2, 3]


def test_hot_day_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(DAY))
        .otherwise(F.date_add(F.lit(DAY), (F.col("id") % 5).cast("int")))
        .alias("load_date"),
        F.col("id").cast("string").alias("player_key"),
        F.repeat(F.md5(F.col("id").cast("string")), 4).alias("payload"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "256k")
        partitions.write_partitions(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set(size, before)
    hot = list((tmp_path / "t" / f"load_date={DAY}").glob("*.parquet"))
    assert len(hot) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60000


def test_catalog_registration(spark, tmp_path):
    root = str(tmp_path / "participants")
    name = "participants_" + tmp_path.name.replace("-", "_")
    matches.create_participant_table(spark, name, root)
    assert set(spark.table(name).columns) == set(RAW.fieldNames()) | {"load_date", "player_key"}
    data = spark.createDataFrame([], daily.STORED).select("*")
    row = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in RAW.fields],
        F.lit("a_1").alias("player_key"),
    )
    row.write.parquet(f"{root}/load_date=2024-01-30")
    assert spark.table(name).count() == 0
    for _ in range(2):
        partitions.register_partition(
            spark, name, f"{root}/load_date=2024-01-30", load_date="2024-01-30"
        )
    assert spark.table(name).count() == 1
    row.write.parquet(f"{root}/load_date=2024-01-29")
    partitions.register_all(spark, name)
    assert spark.table(name).where("load_date = '2024-01-29'").count() == 1
    assert data.count() == 0
    spark.sql(f"DROP TABLE {name}")


def test_daily_jobs_end_to_end(spark, tmp_path):
    places = daily.Places(str(tmp_path))
    landing = tmp_path / "landing"
    roster = roster_of(spark, ["Alpha#T1", "Бета#T1", "Absent#T1"])

    def played(match, kills, created, name="Alpha"):
        own = {
            "participantId": 1,
            "riotIdGameName": name,
            "riotIdTagline": "T1",
            "championName": "Ahri",
            "kills": kills,
            "assists": 0,
            "deaths": 1,
        }
        other = {"participantId": 2, "riotIdGameName": "x", "riotIdTagline": "y", "kills": 99}
        return document(match, [own, other], created=created)

    land(landing, "2024-01-22", "Alpha#T1", [played("RU_1", 5, "2024-01-22T10:00:00")])
    land(landing, "2024-01-30", "Alpha#T1", [played("RU_2", 9, "2024-01-30T10:00:00"), "{"])
    land(landing, "2024-01-30", "Alpha#T1", [played("RU_2", 9, "2024-01-30T10:00:00")])
    land(landing, "2024-01-30", "Stranger#T1", [played("RU_3", 50, "2024-01-30T10:00:00", "Stranger")])
    as_of = dt.date(2024, 1, 31)
    for _ in range(2):
        daily.daily_ingest(spark, places, roster, as_of, days=9)
        assert daily.read_table(spark, places).count() == 4
    # A file that comes after others of its player-day, and one filed under a later day.
    land(landing, "2024-01-30", "Alpha#T1", [played("RU_4", 8, "2024-01-30T11:00:00")])
    land(landing, "2024-01-30", "Бета#T1", [played("RU_5", 3, "2024-01-28T11:00:00", "Бета")])
    daily.daily_ingest(spark, places, roster, as_of, days=9)
    table = daily.read_table(spark, places)
    assert table.count() == 8
    days = {r["metadata.matchId"]: str(r.load_date) for r in table.collect()}
    assert days["RU_4"] == "2024-01-30" and days["RU_5"] == "2024-01-28"
    rejects = spark.read.parquet(places.rejected_daily).collect()
    assert [(r[matches.CORRUPT], str(r.run)) for r in rejects] == [("{", "2024-01-31")]

    daily.refresh_models(spark, places, roster, as_of)
    found = daily.current_messages(spark, places, roster, as_of).collect()
    assert {r.metric for r in found} == {"kills"}
    assert "RU_2" in found[0].text and found[0].source_nickname == "Alpha#T1"
    sent = "msg_id string, ts timestamp, payload string"
    for _ in range(2):
        message = spark.createDataFrame([("t1", dt.datetime(2024, 1, 31, 9), "{}")], sent)
        triggers.publish_trigger(message, places.triggers)
    daily.serve_triggers(spark, places, roster, as_of).awaitTermination()
    served = snapshots.read_snapshot(spark, places.messages).collect()
    assert [(r.label, r.text) for r in served] == [("(1/1)", found[0].text)]
    assert spark.read.parquet(places.ledger).count() == 1

    weekly = daily.build_weekly(spark, places, roster, as_of).collect()
    assert sorted((r.source_nickname, str(r.week_start), r.avg_kda) for r in weekly) == [
        ("Alpha#T1", "2024-01-22", 5.0),
        ("Бета#T1", "2024-01-22", 3.0),
    ]


def test_players_with_one_path_form_are_two(spark, tmp_path):
    places = daily.Places(str(tmp_path))
    roster = roster_of(spark, ["A#B_1", "A_B#1"])
    for match, player in (("RU_1", "A#B_1"), ("RU_2", "A_B#1"), ("RU_1", "A_B#1")):
        target = tmp_path / "landing" / f"load_date={DAY}"
        target.mkdir(parents=True, exist_ok=True)
        body = {**document(match), "source_nickname": player}
        (target / f"{match}-{player[1] == '#'}.json").write_text(json.dumps(body))
    for _ in range(2):
        daily.daily_ingest(spark, places, roster, "2024-01-31")
        rows = daily.read_table(spark, places).collect()
        found = sorted((r["metadata.matchId"], r.source_nickname) for r in rows)
        assert found == [("RU_1", "A#B_1"), ("RU_1", "A_B#1"), ("RU_2", "A_B#1")]


def test_no_day_is_capped_unless_asked_for(spark, tmp_path):
    places = daily.Places(str(tmp_path))
    roster = roster_of(spark, ["Alpha#T1"])
    land(tmp_path / "landing", DAY, "Alpha#T1", [document(f"RU_{i}") for i in range(130)])
    daily.daily_ingest(spark, places, roster, "2024-01-31")
    assert daily.read_table(spark, places).count() == 130
    capped = daily.Places(str(tmp_path / "capped"), landing_folder="../landing")
    daily.daily_ingest(spark, capped, roster, "2024-01-31", per_day=100)
    assert daily.read_table(spark, capped).count() == 100


def test_malformed_ids_and_empty_landing(spark, tmp_path):
    places = daily.Places(str(tmp_path))
    with pytest.raises(ValueError, match="NoTag"):
        daily.daily_ingest(spark, places, roster_of(spark, ["Alpha#T1", "NoTag"]), "2024-01-31")
    land(tmp_path / "landing", DAY, "Stranger#T1", [document("RU_1")])
    daily.daily_ingest(spark, places, roster_of(spark, ["Alpha#T1"]), "2024-01-31")
    assert daily.read_table(spark, places).count() == 0


def test_documents_cross_one_shuffle(spark, tmp_path):
    land(tmp_path, DAY, "Alpha#T1", [document("RU_1")])
    documents = ingest.own_day(matches.valid_matches(matches.read_matches(spark, str(tmp_path))))
    landed = spark.createDataFrame([], RAW).select("source_nickname", "`metadata.matchId`")
    plan = ingest.new_matches(documents, landed.hint("merge"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and sum("match#" in line for line in exchanges) == 2


def test_streamed_table_has_the_stored_schema(spark, tmp_path):
    places = daily.Places(str(tmp_path))
    land(tmp_path / "landing", "2024-01-30", "Alpha#T1", [document("RU_1")])
    daily.stream_ingest(spark, places).awaitTermination()
    row = daily.read_table(spark, places).first()
    assert (row["metadata.matchId"], row.player_key) == ("RU_1", "Alpha_T1")
    assert row["info.gameDuration"] == 1800 and row.load_date == DAY


@pytest.mark.parametrize("as_of", ["2024-01-31", None])
def test_day_folders_and_time_bounds_reach_the_scan(spark, tmp_path, as_of):
    places = daily.Places(str(tmp_path))
    row = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in daily.STORED.fields]
    )
    row.drop("load_date").write.parquet(f"{places.participants}/load_date={DAY}")
    found = daily.build_records(spark, places, roster_of(spark, ["Alpha#T1"]), as_of)
    text = found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    filters = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) == 2 and all(">= 20" in line and "<= 20" in line for line in filters)
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert sum("GreaterThanOrEqual(`info.gameCreation`" in line for line in pushed) == 2


def test_read_roster(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"roster_ord": 1, "nickname": "Alpha#T1"}\n')
    assert read_roster(spark, str(tmp_path / "r.json")).first().nickname == "Alpha#T1"


def test_match_schema_shape():
    assert MATCH["info"].dataType["participants"].dataType.elementType["perks"] is not None
    assert len(MATCH["info"].dataType["participants"].dataType.elementType.fields) == 145


def test_documents_are_dealt_by_number_and_never_sorted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "DOCUMENTS_A_TASK", 2, raising=False)
    land(tmp_path, DAY, "Alpha#T1", [document(f"RU_{n % 30}") for n in range(60)])
    found = matches.read_matches(spark, str(tmp_path)).withColumn("at", F.monotonically_increasing_id())
    documents = ingest.own_day(found.localCheckpoint())
    landed = spark.createDataFrame([("Alpha#T1", "RU_1")], "source_nickname string, `metadata.matchId` string")
    fresh = ingest.new_matches(documents, landed, "at")
    assert "at" not in fresh.columns
    assert sorted(r.match for r in fresh.select("match").collect()) == sorted(f"RU_{n}" for n in range(30) if n != 1)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan and "ShuffledHashJoin" in plan
    assert fresh.rdd.getNumPartitions() >= 15


def stored_folders(spark):
    root = pathlib.Path(scratch_root(spark).removeprefix("file:"))
    return {path.name for path in root.glob("stored-*")}


def test_stored_rows_and_shuffle_setting_last_as_long_as_the_job(spark):
    setting = spark.conf.get(FREE_SHUFFLES, None)
    kept = cut_lineage(spark.range(3))
    before = stored_folders(spark)
    with pytest.raises(ValueError), frees_disk(spark):
        assert spark.conf.get(FREE_SHUFFLES) == "true"
        with frees_disk(spark):
            cut_lineage(spark.range(4))
        assert stored_folders(spark) == before and spark.conf.get(FREE_SHUFFLES) == "true"
        assert cut_lineage(spark.range(5), "row", "zstd").count() == 5
        raise ValueError
    assert stored_folders(spark) == before and spark.conf.get(FREE_SHUFFLES, None) == setting
    assert kept.count() == 3


def test_daily_ingest_writes_in_rounds_and_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    places = daily.Places(str(tmp_path))
    players, days = ["Alpha#T1", "Beta#T1", "Gamma#T1"], ["2024-01-28", "2024-01-29", "2024-01-30"]
    for day in days:
        for player in players:
            # Two files hold a match, and one was played the day before it was filed.
            repeated = document("RU_0", created="2024-01-28T01:00:00")
            own = [document(f"RU_{day}_{n}", created=f"{day}T1{n}:00:00") for n in range(4)]
            land(tmp_path / "landing", day, player, [repeated, *own])
    written, write = [], daily.write_partitions
    monkeypatch.setattr(daily, "write_partitions", lambda rows, path: written.append(path) or write(rows, path))
    monkeypatch.setattr(ingest, "DOCUMENTS_A_ROUND", 4, raising=False)
    monkeypatch.setattr(ingest, "DOCUMENTS_A_TASK", 1, raising=False)
    # One document a scan task, so that there are several stored files.
    monkeypatch.setattr(daily, "read_matches", lambda spark, path: matches.read_matches(spark, path).repartition(20))
    before = stored_folders(spark)
    roster = roster_of(spark, players[:2])
    assert len(daily.daily_ingest(spark, places, roster, dt.date(2024, 1, 31))) == 3
    assert stored_folders(spark) == before
    assert len(written) > 1
    rows = daily.read_table(spark, places).select("source_nickname", "`metadata.matchId`").collect()
    wanted = [(p, m) for p in players[:2] for m in ["RU_0", *[f"RU_{d}_{n}" for d in days for n in range(4)]]]
    assert sorted(tuple(r) for r in rows) == sorted(wanted)
    daily.daily_ingest(spark, places, roster, dt.date(2024, 1, 31))
    assert daily.read_table(spark, places).count() == len(wanted)


def test_rounds_keep_the_newest_of_a_player_and_day(spark, tmp_path, monkeypatch):
    places = daily.Places(str(tmp_path))
    for n in range(24):
        land(tmp_path / "landing", DAY, "Alpha#T1", [document(f"RU_{n}", created=f"{DAY}T{n:02}:00:00")])
    monkeypatch.setattr(ingest, "DOCUMENTS_A_ROUND", 1, raising=False)
    monkeypatch.setattr(ingest, "DOCUMENTS_A_TASK", 1, raising=False)
    monkeypatch.setattr(daily, "read_matches", lambda spark, path: matches.read_matches(spark, path).repartition(24))
    daily.daily_ingest(spark, places, roster_of(spark, ["Alpha#T1"]), dt.date(2024, 1, 31), per_day=2)
    rows = daily.read_table(spark, places).select("`metadata.matchId`").collect()
    assert sorted(r[0] for r in rows) == ["RU_22", "RU_23"]


def test_a_long_roster_does_not_have_documents_shuffled(spark, tmp_path, monkeypatch):
    """By player only keys are shuffled: no exchange by player holds a document's info."""
    places = daily.Places(str(tmp_path))
    land(tmp_path / "landing", DAY, "Alpha#T1", [document("RU_1")])
    plans, write = [], daily.write_partitions

    def seen(rows, path):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, path)

    monkeypatch.setattr(daily, "write_partitions", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        daily.daily_ingest(spark, places, roster_of(spark, ["Alpha#T1"]), dt.date(2024, 1, 31))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plans and not any("hashpartitioning(source_nickname" in plan for plan in plans)
    assert daily.read_table(spark, places).count() == 1


def test_a_stream_batch_leaves_nothing_behind(spark, tmp_path):
    places = daily.Places(str(tmp_path))
    for n in range(2):
        land(tmp_path / "landing", DAY, "Alpha#T1", [document("RU_1"), document(f"RU_{n + 2}")])
    before = stored_folders(spark)
    daily.stream_ingest(spark, places).awaitTermination()
    assert stored_folders(spark) == before
    assert daily.read_table(spark, places).count() == 3
