"""One key holds a third of the rows: what crosses the shuffles stays small."""

import pytest
from pyspark.sql import functions as F

from matchpeaks.metrics import MetricSpec
from matchpeaks.operators import assets, messages, ranking, records, weekly

ROWS, TASKS = 60000, 6
TABLE = records.GameTable("player", "match", "champion", "ts")


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Players, champions and matches of which one each holds a third of all rows."""
    path = str(tmp_path_factory.mktemp("hot") / "t")
    third = F.col("id") % 3 == 0
    spark.range(ROWS, numPartitions=TASKS).select(
        F.when(third, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("player"),
        F.when(third, "m0").otherwise(F.format_string("m%d", "id")).alias("match"),
        F.when(third, "Ahri").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("champion"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,int(id div 3 % 30))").alias(
            "ts"
        ),
        F.col("id").alias("high"),
        (F.col("id") % 977).cast("double").alias("low"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def shuffled_rows(df):
    """Rows written by all shuffles of a plan that is run without adaptive changes."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df.select("*")._jdf.queryExecution()
        execution.toRdd().count()
        total, todo = 0, [execution.executedPlan()]
        while todo:
            node = todo.pop()
            if node.nodeName() == "Exchange":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
        return total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_records(hot):
    specs = [MetricSpec("high"), MetricSpec("low", "min")]
    players = hot.select(F.col("player").alias("nickname")).distinct()
    found = records.record_detect(hot, players, specs, "2024-01-31", table=TABLE)
    # today, history and the roster: at most one row per player and task each.
    assert 51 < shuffled_rows(found) <= 3 * 51 * TASKS + 3 * 51


def test_weekly(spark, hot):
    roster = spark.createDataFrame([("hot",)], "nickname string")
    found = weekly.weekly_average(
        hot, F.col("low"), roster, "2024-01-31", player="player", time="ts"
    )
    assert 51 < shuffled_rows(found) <= 5 * 51 * TASKS + 500


def test_cap_and_repeats(hot):
    rows = hot.select(
        F.col("player").alias("source_nickname"),
        F.lit("high").alias("metric"),
        F.col("match").alias("match_id"),
        "champion",
        F.col("high").alias("at"),
    )
    order = [F.col("at")]
    capped = messages.cap_per_champion(rows, order)
    assert 41 < shuffled_rows(capped) <= 3 * 41 * TASKS
    # A third of the rows are copies of one key; only one per task is sent.
    once = messages.dedupe_messages(rows, order)
    assert ROWS / 2 < shuffled_rows(once) <= ROWS * 2 / 3 + TASKS
    assert once.count() == ROWS * 2 / 3 + 1


def test_pick_and_lists(hot):
    files = hot.select("champion", F.col("high").alias("num"), F.col("match").alias("file"))
    manifest = files.select(F.col("champion").alias("champ_norm"), F.col("num").alias("pos"), "file")
    assert 41 <= shuffled_rows(assets.pick_random(manifest, 1)) <= 41 * TASKS
    assert assets.collect_files(files).agg(F.max(F.size("files"))).first()[0] <= assets.CHUNK


def test_numbering_spreads_the_rows(hot):
    numbered = ranking.number_rows(hot.select("player", "high"), [F.col("player"), F.col("high")])
    assert numbered.agg(F.max("pos")).first()[0] == ROWS
    assert numbered.where("player = 'hot'").count() == ROWS / 3
    # Stored once; reading it back needs no shuffle of the rows.
    assert 0 < shuffled_rows(numbered) <= 100
