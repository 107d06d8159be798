from pyspark.sql import functions as F

from matchpeaks.operators import ranking


def hot_rows(spark, n=3000):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7))
    return spark.range(n, numPartitions=4).select(key.alias("key"), F.col("id").alias("v"))


def expected(rows, k):
    best = {}
    for row in sorted(rows, key=lambda r: -r.v):
        best.setdefault(row.key, [])
        if len(best[row.key]) < k:
            best[row.key].append(row.v)
    return sorted((key, v) for key, values in best.items() for v in values)


def test_top_per_group_small_and_very_large_k(spark):
    df = hot_rows(spark)
    rows = df.collect()
    threshold = int(spark.conf.get(ranking.GROUP_LIMIT_THRESHOLD))
    for k in (1, 5, threshold - 100, threshold):
        found = ranking.top_per_group(df, ["key"], [F.col("v").desc()], k)
        assert found.columns == ["key", "v"]
        assert sorted((r.key, r.v) for r in found.collect()) == expected(rows, k)


def test_rank_column(spark):
    found = ranking.top_per_group(hot_rows(spark), ["key"], [F.col("v").desc()], 2, rank="place")
    hot = found.where("key = 'hot'").orderBy("place").collect()
    assert [(r.v, r.place) for r in hot] == [(2997, 1), (2994, 2)]


def test_number_rows_over_many_ranges(spark):
    df = spark.range(5000, numPartitions=8).select(((F.col("id") * 7919) % 5000).alias("v"))
    found = ranking.number_rows(df, [F.col("v").desc()]).collect()
    assert sorted((r.pos, r.v) for r in found) == [(i + 1, 4999 - i) for i in range(5000)]
    assert {r.total for r in found} == {5000}


def test_number_rows_of_nothing(spark):
    df = spark.range(0).select(F.col("id").alias("v"))
    assert ranking.number_rows(df, [F.col("v")]).collect() == []


def test_dotted_names(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "`x.key` string, `x.v` int")
    found = ranking.first_per_key(df, ["x.key"], [F.col("`x.v`").desc()])
    assert found.first()["x.v"] == 2
