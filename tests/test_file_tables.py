import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from matchpeaks.sources import leases
from matchpeaks.sources.file_tables import FileTable, packed

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("dotted.name", T.StringType()),
        T.StructField("load_date", T.DateType()),
    ]
)
DAYS = [dt.date(2024, 1, n) for n in (1, 2, 3)]


def rows_of(spark, ids):
    day = F.element_at(F.array(*[F.lit(d) for d in DAYS]), (F.col("id") % 3 + 1).cast("int"))
    named = F.concat(F.lit("n"), F.col("id")).alias("dotted.name")
    return spark.range(*ids).select("id", named, day.alias("load_date"))


def table_of(spark, tmp_path):
    return FileTable(spark, str(tmp_path / "t"), SCHEMA, sort_by=("id",))


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


def test_append_read_and_merge(spark, tmp_path):
    table = table_of(spark, tmp_path)
    assert table.read().count() == 0 and table.compact() == 0
    for n in range(4):
        assert table.append(rows_of(spark, (n * 30, n * 30 + 30)).repartition(3), f"batch-{n}")
    assert not table.append(rows_of(spark, (0, 30)), "batch-2")  # made before
    before = table.read()
    many = table.files().count()
    assert many > 9 and table.compact() == many
    assert table.files().count() == len(DAYS)  # all files are small: one bin a day
    assert ids(before) == ids(table.read()) == list(range(120))
    assert table.compact() == 0
    picked = table.read(F.col("day") == F.lit(DAYS[1]))
    assert {r["load_date"] for r in picked.collect()} == {DAYS[1]} and picked.count() == 40
    assert picked.columns == SCHEMA.fieldNames() and picked.first()["dotted.name"].startswith("n")


def test_a_batch_cut_short_is_written_again(spark, tmp_path):
    table = table_of(spark, tmp_path)
    table._write(rows_of(spark, (0, 50)), "batch-0")  # written, not committed
    assert table.read().count() == 0
    table.append(rows_of(spark, (0, 20)), "batch-0")
    assert ids(table.read()) == list(range(20))


def test_an_empty_batch_counts_as_made(spark, tmp_path):
    table = table_of(spark, tmp_path)
    assert table.append(rows_of(spark, (0, 0)), "batch-0")
    assert not table.append(rows_of(spark, (0, 9)), "batch-0") and table.read().count() == 0


def test_rows_without_a_day_are_kept(spark, tmp_path):
    table = table_of(spark, tmp_path)
    for n in range(3):
        table.append(spark.createDataFrame([(n, "x", None)], SCHEMA))
    assert table.compact() == 3 and ids(table.read()) == [0, 1, 2] and table.files().count() == 1


@pytest.mark.parametrize("target", [100, 256, 1000])
def test_bins_are_bounded(spark, target):
    sizes = [(f"f{i}", DAYS[i % 2], (i * 37) % 300 + 1) for i in range(200)]
    binned = packed(spark.createDataFrame(sizes, "path string, day date, bytes bigint"), target).collect()
    by_bin = {}
    for row in binned:
        by_bin.setdefault((row["day"], row["bin"]), []).append(row["bytes"])
    assert all(len(x) > 1 and sum(x) < 2 * target for x in by_bin.values())
    for day in DAYS[:2]:
        small = sum(b for _, d, b in sizes if d == day and b < target)
        assert sum(d == day for d, _ in by_bin) <= small // target + 1


def test_file_count_follows_the_size_not_the_number_of_batches(spark, tmp_path):
    table = table_of(spark, tmp_path)
    for n in range(6):
        table.append(rows_of(spark, (n * 300, n * 300 + 300)).repartition(4))
    total = table.files().agg(F.sum("bytes")).first()[0]
    table.compact(target_bytes=12_000)
    assert table.files().count() <= len(DAYS) * 2 + 2 * total // 12_000
    assert ids(table.read()) == list(range(1800))


def test_merging_in_parts(spark, tmp_path):
    table = table_of(spark, tmp_path)
    for n in range(3):
        table.append(rows_of(spark, (n * 9, n * 9 + 9)))
    table.compact(files_at_once=4)
    assert table.files().count() <= 4 and ids(table.read()) == list(range(27))


def test_one_merge_at_a_time(spark, tmp_path):
    table = table_of(spark, tmp_path)
    for n in range(2):
        table.append(rows_of(spark, (n, n + 1)))
    with leases.acquire(spark, f"{table.root}/lease"):
        assert table.compact() == 0
    assert table.compact() > 0 or table.files().count() == 2


def test_replaced_files_go_after_their_time(spark, tmp_path):
    table = table_of(spark, tmp_path)
    for n in range(3):
        table.append(rows_of(spark, (n * 9, n * 9 + 9)))
    reader = table.read()
    table.compact()
    table._write(rows_of(spark, (0, 5)), "lost")
    hour = dt.timedelta(hours=1)
    assert table.retire(hour) == 0 and ids(reader) == list(range(27))
    later = dt.datetime.now(dt.timezone.utc) + 2 * hour
    assert table.retire(hour, now=later) >= 10
    assert ids(table.read()) == list(range(27)) and not (tmp_path / "t/data/lost").exists()
