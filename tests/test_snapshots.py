import datetime as dt
import threading
import time

import pytest

from matchpeaks import session
from matchpeaks.sources import leases, partitions, snapshots


def test_freshness(spark, tmp_path):
    root = str(tmp_path / "s")
    calls = []

    def compute():
        calls.append(1)
        return spark.createDataFrame([(len(calls),)], "n int")

    def load(hours, **options):
        now = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc) + dt.timedelta(hours=hours)
        found = snapshots.load_snapshot(spark, root, compute, now=now, **options).first().n
        snapshots.wait_for_refresh(root)
        return found

    assert snapshots.latest_commit(spark, root) is None
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, root)
    assert load(0) == 1
    assert load(6) == 1
    assert load(7) == 1  # too old: served once more, refreshed for the next caller
    assert load(7) == 2
    assert load(14, serve_stale=False) == 3
    assert load(14, force=True) == 4
    assert snapshots.read_snapshot(spark, root).first().n == 4
    assert snapshots.latest_commit(spark, root).written_rows == 1


def test_a_stale_caller_does_not_wait(spark, tmp_path):
    root = str(tmp_path / "s")
    snapshots.write_snapshot(spark.range(3), root)
    gate, calls = threading.Event(), []

    def compute():
        calls.append(1)
        assert gate.wait(60)
        return spark.range(5)

    for _ in range(3):  # the first starts the refresh, the others find it running
        assert snapshots.load_snapshot(spark, root, compute, max_age_seconds=-1).count() == 3
    gate.set()
    snapshots.wait_for_refresh(root)
    assert len(calls) == 1 and snapshots.read_snapshot(spark, root).count() == 5


def test_two_processes_make_one_refresh(spark, tmp_path):
    """Threads that don't know of each other stand for processes."""
    root, calls = str(tmp_path / "s"), []
    snapshots.write_snapshot(spark.range(3), root)

    def compute():
        calls.append(1)
        time.sleep(3)
        return spark.range(5)

    threads = [snapshots.start_refresh(spark, root, compute) for _ in range(3)]
    for thread in threads:
        thread.join()
    assert len(calls) == 1 and snapshots.latest_commit(spark, root).seq == 2
    assert leases.live_claims(spark, f"{root}/lease") == []


def test_a_failed_refresh_frees_the_lease(spark, tmp_path):
    root = str(tmp_path / "s")
    snapshots.write_snapshot(spark.range(3), root)
    snapshots.load_snapshot(spark, root, lambda: spark.table("no_such_table"), max_age_seconds=-1)
    snapshots.wait_for_refresh(root)
    assert snapshots.read_snapshot(spark, root).count() == 3
    assert leases.acquire(spark, f"{root}/lease") is not None


def test_a_lease_ends_with_its_time(spark, tmp_path):
    path = str(tmp_path / "lease")
    assert leases.acquire(spark, path, dt.timedelta(hours=1)) is not None
    assert leases.acquire(spark, path) is None
    other = str(tmp_path / "other")
    assert leases.acquire(spark, other, dt.timedelta(0)) is not None
    time.sleep(6)
    assert leases.acquire(spark, other, tries=1) is not None


def test_a_reader_keeps_its_snapshot(spark, tmp_path):
    root = str(tmp_path / "s")
    first = snapshots.write_snapshot(spark.range(3), root)
    snapshots.write_snapshot(first.where("id > 0"), root)
    assert first.count() == 3
    assert snapshots.read_snapshot(spark, root).count() == 2


def test_a_lost_write_stays_invisible(spark, tmp_path):
    root = str(tmp_path / "s")
    snapshots.write_snapshot(spark.range(3), root)
    with pytest.raises(Exception):
        snapshots.write_snapshot(spark.range(5).selectExpr("raise_error('lost') AS x"), root)
    assert snapshots.read_snapshot(spark, root).count() == 3


def test_table_and_view(spark, tmp_path):
    name = "mat_" + tmp_path.name.replace("-", "_")
    for count in (3, 2):
        partitions.materialize_table(spark.range(count), name, str(tmp_path / "t"))
        assert spark.table(name).count() == count
    partitions.materialize_view(spark.range(4), name + "_v")
    assert spark.table(name + "_v").count() == 4
    spark.sql(f"DROP TABLE {name}")


def test_scratch_paths_are_fresh_and_shared(spark):
    one, two = (session.scratch_dir(spark, "x") for _ in range(2))
    assert one != two
    assert one.startswith(session.scratch_root(spark))
