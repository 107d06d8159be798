import json
from collections import Counter

from pyspark.sql import functions as F

from matchpeaks.operators import assets
from matchpeaks.sources import dimensions


def test_skin_files(spark):
    nested = "map<string,struct<skins:array<struct<num:int>>>>"
    text = json.dumps({"Ahri": {"skins": [{"num": 0}, {"num": 7}]}, "Zed": {"skins": []}})
    df = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", nested).alias("data"))
    rows = assets.skin_files(df).orderBy("num").collect()
    assert [(r.champion, r.num, r.file) for r in rows] == [
        ("Ahri", 0, "Ahri_0.jpg"),
        ("Ahri", 7, "Ahri_7.jpg"),
    ]


def test_lists_are_ordered_and_bounded(spark):
    files = spark.range(2500).select(
        F.lit("hot").alias("champion"), F.col("id").alias("num"), F.concat("id", F.lit(".jpg")).alias("file")
    )
    lists = assets.collect_files(files.repartition(7)).orderBy("chunk").collect()
    assert [len(r.files) for r in lists] == [1000, 1000, 500]
    assert [f for r in lists for f in r.files] == [f"{i}.jpg" for i in range(2500)]


def test_manifest_roundtrip(spark, tmp_path):
    files = spark.createDataFrame(
        [("Lee Sin", 1, "b.jpg"), ("Lee Sin", 0, "a.jpg"), ("Ahri", 0, "/abs/c.jpg")],
        "champion string, num int, file string",
    )
    path = str(tmp_path / "manifest")
    assets.manifest_json(assets.collect_files(files)).write.text(path)
    rows = dimensions.read_manifest(spark, path, "/splashes/").collect()
    assert sorted((r.champ_norm, r.pos, r.file) for r in rows) == [
        ("ahri", 0, "/abs/c.jpg"),
        ("leesin", 0, "/splashes/a.jpg"),
        ("leesin", 1, "/splashes/b.jpg"),
    ]


def test_manifest_of_one_pretty_printed_object(spark, tmp_path):
    path = tmp_path / "manifest.json"
    body = {"Lee Sin": ["old.jpg"], "Zed": "no list", "LeeSin": ["new.jpg"], "Vi": {"a": 1}, "Jax": []}
    path.write_text(json.dumps(body, indent=2))
    rows = dimensions.read_manifest(spark, str(path), whole_file=True).collect()
    assert [(r.champion, r.file) for r in rows] == [("LeeSin", "new.jpg")]


def test_pick_is_repeatable_and_even(spark):
    manifest = spark.range(4000).select(
        F.concat(F.lit("c"), (F.col("id") / 4).cast("int")).alias("champ_norm"),
        (F.col("id") % 4).alias("pos"),
        F.concat(F.lit("f"), F.col("id") % 4).alias("file"),
    )
    first = {r.champ_norm: r.file for r in assets.pick_random(manifest, 1).collect()}
    again = {r.champ_norm: r.file for r in assets.pick_random(manifest.repartition(9), 1).collect()}
    other = {r.champ_norm: r.file for r in assets.pick_random(manifest, 2).collect()}
    assert first == again and first != other and len(first) == 1000
    counts = Counter(first.values())
    assert set(counts) == {"f0", "f1", "f2", "f3"} and min(counts.values()) > 200


def test_join_by_normalised_name(spark):
    messages = spark.createDataFrame([("Lee Sin", "t1"), ("Nobody", "t2")], "champion string, text string")
    picks = spark.createDataFrame([("leesin", "a.jpg")], "champ_norm string, file string")
    found = {r.text: r.file for r in assets.manifest_join(messages, picks).collect()}
    assert found == {"t1": "a.jpg", "t2": None}


def test_prune_lists_but_deletes_nothing(spark, tmp_path):
    for name in ("a.jpg", "b.jpg", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    present = assets.present_files(spark, str(tmp_path))
    listed = spark.createDataFrame([("a.jpg",), ("a.jpg",)], "file string")
    assert [r.file for r in assets.prune_unlisted(present, listed, "file").collect()] == ["b.jpg"]
    assert (tmp_path / "b.jpg").exists()
