import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchpeaks.llm import importance_resampling as r

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_buckets(text, buckets):
    words = plain_words(text)
    return [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for i in range(len(words)) for k in (1, 2, 3) if i + k <= len(words)]


def plain(docs, target, buckets, percent, least):
    s, t = ([0] * buckets for _ in range(2))
    for side, rows in ((s, docs), (t, target)):
        for _, text in rows:
            for b in plain_buckets(text, buckets):
                side[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    scored = []
    for d, text in docs:
        found = plain_buckets(text, buckets)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((d, len(found), weight, score, len(plain_words(text)) >= least))
    order = sorted((x for x in scored if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    k = percent * len(order) // 100
    drawn = [(*x[:4], i + 1 if i < k else None) for i, x in enumerate(order)]
    return sorted(drawn + [(*x[:4], None) for x in scored if not x[4]], key=repr)


@pytest.mark.parametrize("text", ["", "one", "One TWO", "a-b_c é3 ÀÉ 北京 x", "x\x00y İstanbul"])
def test_buckets_are_checksums_of_joined_words(text):
    assert sorted(r.buckets_of(r.words_of(text)).tolist()) == sorted(plain_buckets(text, r.BUCKETS))


@pytest.mark.parametrize("seed, percent, least, partitions", [(1, 5, 3, 4), (2, 50, 1, 9), (3, 100, 2, 1), (4, 1, 2, 3)])
def test_against_plain_draw(spark, seed, percent, least, partitions):
    rng = random.Random(seed)
    made = lambda: " ".join(rng.choice(["Ab", "cd", "é", "x1", "y"]) for _ in range(rng.randrange(12)))
    docs = [(rng.choice([None, rng.randrange(500)]), rng.choice([None, made(), made()])) for _ in range(200)]
    docs += [docs[0]] * 5 + [(9, "ab cd é")] * 40
    target = [(i, made()) for i in range(10)]
    given = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(partitions)
    found = r.resample(given, spark.createDataFrame(target, "item_id bigint, text string"), percent, least, 50)
    assert sorted(map(tuple, found.collect()), key=repr) == plain(docs, target, 50, percent, least)


def test_shared_table(spark, documents):
    target = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    found = r.op12_importance_resampling(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, found), key=repr) == plain(documents, target, r.BUCKETS, 5, 20)


@pytest.mark.parametrize("seed", range(6))
def test_cutoff_is_the_kth_key(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([1, 2, 50, 400])
    keys = [(rng.randrange(-5, 5), rng.randrange(rng.choice([2, 1000])), rng.randrange(3)) for _ in range(n)]
    df = spark.createDataFrame(keys, "low bigint, late bigint, more bigint").repartition(rng.choice([1, 5]))
    for k in {1, n, (n + 1) // 2, rng.randint(1, n)}:
        assert r.cutoff(df, k) == sorted(keys)[k - 1]


def test_pivot_discards_a_quarter_for_certain():
    rng = np.random.default_rng(5)
    for _ in range(200):
        parts = [np.sort(rng.integers(0, 10**6, rng.integers(1, 60))) for _ in range(rng.integers(1, 20))]
        pivot = r.weighted_median([((int(p[len(p) // 2]), 0, 0), len(p)) for p in parts])[0]
        every = np.concatenate(parts)
        assert (every >= pivot).sum() * 4 >= len(every) and (every <= pivot).sum() * 4 >= len(every)


def test_awkward_rows(spark, awkward, nothing):
    target = spark.createDataFrame([(1, None), (None, "no id")], "item_id bigint, text string")
    rows = r.resample(awkward, target).collect()
    assert sorted(str(x["doc_id"]) for x in rows) == sorted(["1", "2", "3", "4", "5", "5", "None", "None", "6", "7"])
    assert all(x["rank"] is None and x["weight"] == 0 for x in rows if x["n_features"] == 0)
    assert r.resample(nothing, target).collect() == []
    assert r.resample(awkward, target.limit(0)).count() == 10


def test_ties_of_a_whole_table_are_numbered_once(spark):
    """All weights equal: the ids decide."""
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("w " * 30).alias("text"))
    found = r.resample(docs, docs.limit(3).withColumnRenamed("doc_id", "item_id"))
    ranks = [x["rank"] for x in found.collect() if x["rank"]]
    assert sorted(ranks) == list(range(1, 101))
