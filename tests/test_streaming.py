import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException

from matchpeaks.streaming import ingest, triggers
from test_ingest import document, land

START = dt.datetime(2024, 1, 31, 12, 0)


def send(spark, path, *ids, minute=0):
    rows = [(i, START + dt.timedelta(minutes=minute), json.dumps({"n": i})) for i in ids]
    df = spark.createDataFrame(rows, "msg_id string, ts timestamp, payload string")
    triggers.publish_trigger(df, path)


def run(spark, root, refresh, **options):
    stream = triggers.dedupe_triggers(triggers.read_triggers(spark, f"{root}/in"), **options)
    query = triggers.on_trigger(stream, refresh, f"{root}/at", f"{root}/ledger")
    query.awaitTermination()


@pytest.mark.parametrize("salted", [True, False])
def test_each_message_once_over_restarts(spark, tmp_path, salted):
    root = str(tmp_path)
    handled = []

    def refresh(batch, batch_id):
        handled.append(sorted(r.msg_id for r in batch.collect()))

    send(spark, f"{root}/in", "a", "a", "b")
    run(spark, root, refresh, salted=salted)
    run(spark, root, refresh, salted=salted)
    assert handled == [["a", "b"]]
    send(spark, f"{root}/in", "a", "c", minute=1)
    run(spark, root, refresh, salted=salted)
    assert handled == [["a", "b"], ["c"]]
    assert sorted(r.msg_id for r in spark.read.parquet(f"{root}/ledger").collect()) == ["a", "b", "c"]


def test_state_is_kept_without_a_ledger(spark, tmp_path):
    root = str(tmp_path)
    handled = []
    for minute, ids in enumerate((["a", "b", "c", "d"], ["a", "b", "c", "d", "e"], ["e", "f"])):
        send(spark, f"{root}/in", *ids, minute=minute)
        stream = triggers.dedupe_triggers(triggers.read_triggers(spark, f"{root}/in"), "1 hour")
        triggers.on_trigger(
            stream,
            lambda batch, _: handled.append(sorted(r.msg_id for r in batch.collect())),
            f"{root}/at",
        ).awaitTermination()
    assert handled == [["a", "b", "c", "d"], ["e"], ["f"]]


def test_an_older_message_is_never_late(spark, tmp_path):
    root, handled = str(tmp_path), []
    for minute, name in ((10, "a"), (0, "late"), (11, "c"), (-600, "later"), (0, "late")):
        send(spark, f"{root}/in", name, minute=minute)
        run(spark, root, lambda batch, _: handled.extend(r.msg_id for r in batch.collect()))
    assert handled == ["a", "late", "c", "later"]


def test_a_failed_refresh_comes_again(spark, tmp_path):
    root = str(tmp_path)
    seen = []

    def refresh(batch, batch_id):
        seen.append((batch_id, [r.msg_id for r in batch.collect()]))
        if len(seen) == 1:
            raise RuntimeError("not now")

    send(spark, f"{root}/in", "a")
    with pytest.raises(StreamingQueryException):
        run(spark, root, refresh)
    run(spark, root, refresh)
    assert seen == [(0, ["a"]), (0, ["a"])]
    assert spark.read.parquet(f"{root}/ledger").count() == 1


def test_each_file_is_ingested_once(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")

    def ingest_all():
        stream = ingest.stream_matches(spark, str(landing), files_per_batch=1)
        ingest.ingest_stream(
            stream, table, str(tmp_path / "at"), str(tmp_path / "rejected")
        ).awaitTermination()
        rows = ingest.streamed_table(spark, table).read().collect()
        return sorted(r["metadata.matchId"] for r in rows)

    land(landing, "2024-01-30", "Alpha#T1", [document("RU_1"), "{", document("RU_2")])
    land(landing, "2024-01-29", "Бета#T1", [document("RU_3")])
    assert ingest_all() == ["RU_1", "RU_2", "RU_3"]
    assert ingest_all() == ["RU_1", "RU_2", "RU_3"]
    land(landing, "2024-01-30", "Alpha#T1", [document("RU_4")])
    assert ingest_all() == ["RU_1", "RU_2", "RU_3", "RU_4"]
    assert spark.read.parquet(str(tmp_path / "rejected")).count() == 1
    keys = {r.player_key for r in ingest.streamed_table(spark, table).read().collect()}
    assert keys == {"Alpha_T1", "Бета_T1"}


def test_a_match_landed_again_counts_once(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    for day in ("2024-01-30", "2024-01-31", "2024-01-31"):
        land(landing, day, "Alpha#T1", [document("RU_1"), document("RU_1"), document("RU_2")])
        stream = ingest.stream_matches(spark, str(landing), files_per_batch=1)
        ingest.ingest_stream(stream, table, str(tmp_path / "at")).awaitTermination()
    rows = ingest.streamed_table(spark, table).read().collect()
    assert sorted(r["metadata.matchId"] for r in rows) == ["RU_1", "RU_2"]


def test_small_files_of_a_stream_are_merged(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    for n in range(5):
        land(landing, "2024-01-30", "Alpha#T1", [document(f"RU_{n}")])
    stream = ingest.stream_matches(spark, str(landing), files_per_batch=1)
    ingest.ingest_stream(stream, table, str(tmp_path / "at"), compact_every=4).awaitTermination()
    found = ingest.streamed_table(spark, table)
    assert sorted(r["metadata.matchId"] for r in found.read().collect()) == [f"RU_{n}" for n in range(5)]
    assert found.files().count() == 2  # the first four, and the fifth


def test_a_message_is_handled_once_however_late_its_repeat(spark, tmp_path):
    """By the ledger, without any state: in one batch, in later ones, and after a new start."""
    root, handled = str(tmp_path), []
    for name in ("a", "b", "a", "c", "a"):
        send(spark, f"{root}/in", name)
        if name != "b":
            stream = triggers.read_triggers(spark, f"{root}/in")
            refresh = lambda batch, _: handled.append(sorted(r.msg_id for r in batch.collect()))
            triggers.on_trigger(stream, refresh, f"{root}/at", f"{root}/ledger").awaitTermination()
    assert handled == [["a"], ["b"], ["c"]]


def test_a_batch_of_one_day_is_written_by_all_its_tasks(spark, tmp_path):
    rows = spark.range(1000, numPartitions=4).withColumn("load_date", F.lit("2024-01-30"))
    triggers.write_by_batch(rows, 0, str(tmp_path / "t"), ("load_date",))
    files = list((tmp_path / "t" / "load_date=2024-01-30" / "batch_id=0").glob("*.parquet"))
    assert len(files) == 4


def test_writing_a_batch_twice_doubles_nothing(spark, tmp_path):
    rows = spark.range(10)
    for batch_id in (0, 0, 1):
        triggers.write_by_batch(rows, batch_id, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20
