import datetime as dt

from matchpeaks.session import cut_lineage, scratch_root
from matchpeaks.sources import retirement, snapshots

HOUR = dt.timedelta(hours=1)


def test_replaced_snapshots_go(spark, tmp_path):
    root = str(tmp_path / "data" / "snaps")
    start = dt.datetime.now(dt.timezone.utc)
    assert retirement.retire_snapshots(spark, root, HOUR) == 0
    for n in range(4):
        snapshots.write_snapshot(spark.range(n), root, start + n * HOUR)
    spark.range(9).write.parquet(f"{root}/data/never-committed")
    reader = snapshots.read_snapshot(spark, root)
    assert retirement.folders_below(spark, f"{root}/data").count() == 5
    assert retirement.retire_snapshots(spark, root, HOUR, start) == 0
    # The third was replaced half an hour ago: a reader may still have it.
    assert retirement.retire_snapshots(spark, root, HOUR, start + 3.5 * HOUR) == 3
    assert retirement.folders_below(spark, f"{root}/data").count() == 2
    assert retirement.retire_snapshots(spark, root, HOUR, start + 9 * HOUR) == 1
    assert reader.count() == 3 and snapshots.read_snapshot(spark, root).count() == 3


def test_scratch_and_run_folders_go_by_age(spark, tmp_path):
    kept = cut_lineage(spark.range(3))
    root = scratch_root(spark)
    assert retirement.retire_scratch(spark, root, HOUR) == 0 and kept.count() == 3
    later = dt.datetime.now(dt.timezone.utc) + 2 * HOUR
    runs = str(tmp_path / "rejected")
    spark.range(3).selectExpr("id", "id % 2 AS run").write.partitionBy("run").parquet(runs)
    assert retirement.retire_runs(spark, runs, HOUR) == 0
    assert retirement.retire_runs(spark, runs, HOUR, later) == 2


def test_paths_that_hold_the_folder_name_twice(spark, tmp_path):
    root = str(tmp_path / "data" / "x" / "data")
    spark.range(1).write.parquet(f"{root}/one/data/two")
    assert [r["folder"] for r in retirement.folders_below(spark, root).collect()] == ["one"]
