import random

import pytest
from pyspark.sql import functions as F

from matchpeaks.operators import messages

SCHEMA = "at bigint, source_nickname string, metric string, match_id string, champion string"


def by_the_rule(rows, k):
    used, seen, kept = {}, set(), []
    for row in sorted(rows):
        at, *key, champion = row
        if used.get(champion, 0) >= k or tuple(key) in seen:
            continue
        used[champion] = used.get(champion, 0) + 1
        seen.add(tuple(key))
        kept.append(row)
    return kept


def ruled(spark, rows, k, monkeypatch):
    """The rows kept, and the number of rounds it took."""
    rounds = []
    decided = messages._decided
    monkeypatch.setattr(messages, "_decided", lambda *a: rounds.append(1) or decided(*a))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = sorted(map(tuple, messages.cap_in_order(df, ("at",), k).collect()))
    return found, len(rounds)


@pytest.mark.parametrize("seed", range(4))
def test_any_input(spark, seed, monkeypatch):
    rng = random.Random(seed)
    n, k = 120, 1 + seed % 3
    rows = [
        (i, rng.choice("pq"), "m", rng.choice([None, *map(str, range(n // 4))]), rng.choice([None, *"ABCDEFGH"[: 2 + 2 * seed]]))
        for i in rng.sample(range(10 * n), n)
    ]
    found, _ = ruled(spark, rows, k, monkeypatch)
    assert found == by_the_rule(rows, k)


def test_a_long_chain_takes_one_round(spark, monkeypatch):
    """Row by row, each one's fate hangs on the row before: by champion, then by key, and so on."""
    rows = [(i, "p", "m", f"key{(i + 1) // 2}", f"champion{i // 2}") for i in range(300)]
    found, rounds = ruled(spark, rows, 1, monkeypatch)
    assert found == by_the_rule(rows, 1) and len(found) == 150 and rounds == 1


def test_one_champion_and_one_key_hold_a_third_each(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, "p", "m", f"k{i}", "hot") for i in range(0, 3000, 3)]
    rows += [(i, "p", "m", "hot", f"c{i}") for i in range(1, 3000, 3)]
    rows += [(i, "p", "m", f"k{rng.randrange(500)}", f"c{rng.randrange(300)}") for i in range(2, 3000, 3)]
    found, rounds = ruled(spark, rows, 3, monkeypatch)
    assert found == by_the_rule(rows, 3) and rounds <= 8


def test_a_task_sees_few_rows_of_a_champion(spark):
    rows = spark.range(5000).select(F.struct((F.col("id") % 2).alias("c")).alias("__champion"), F.struct("id").alias("__key"), F.struct("id").alias("__at"))
    plan = messages.top_per_group(rows, ["__champion"], [F.col("__at")], 4, rank="r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_no_rows(spark):
    assert messages.cap_in_order(spark.createDataFrame([], SCHEMA), ("at",)).collect() == []
