import random

import pytest
from pyspark.sql import functions as F

from matchpeaks.fixed_values import TEMPLATES
from matchpeaks.metrics import match_metrics
from matchpeaks.operators import messages

METRICS = ["m1", "m2", "m3"]
TEXTS = [(m, m + ": {nickname} {value} {matchId} {champion}") for m in METRICS]
SCHEMA = (
    "roster_ord int, source_nickname string, m1 double, m1_meta string, "
    "m2 bigint, m2_meta string, m3 boolean, m3_meta string"
)


def candidates(rows):
    """All messages the records could give, in message order: (text, champion, key)."""
    cells = [
        (row[1], metric, *row[2 + 2 * i : 4 + 2 * i])
        for row in rows
        if row[1]
        for i, metric in enumerate(METRICS)
    ]
    return [message(*cell) for cell in cells if shown(cell[2])]


def shown(value):
    return value is not None and value == value and value != 0


def message(nick, metric, value, meta):
    sides = ((meta or "").split("-_-", 1) + [""])[:2]
    match, champion = sides[0] or "<match>", sides[1] or "<champion>"
    digits = str(int(value)) if type(value) is float and value == int(value) else str(value)
    site = "https://www.leagueofgraphs.com/match/ru/"
    link = f'<a href="{site}{match[3:] if match[:3] == "RU_" else match}">{match}</a>'
    return f"{metric}: {nick} {digits} {link} {champion}", champion, (nick, metric, match)


def assert_follows_the_rule(found, rows, k=3):
    """What is kept breaks no rule, and whatever is left out would have broken one.

    ``found`` must be a subsequence of the candidates. A candidate may be missing only if, among
    the kept ones before it, ``k`` are of its champion or one has its key.
    """
    wanted, kept = list(found), []
    for text, champion, key in candidates(rows):
        full = sum(c == champion for c, _ in kept) >= k
        known = any(other == key for _, other in kept)
        taken = bool(wanted) and wanted[0] == (text, champion)
        assert taken != (full or known), (text, full, known)
        if taken:
            kept.append((champion, key))
            wanted.pop(0)
    assert not wanted


def built(spark, rows, k=3, **options):
    records = spark.createDataFrame(rows, SCHEMA)
    found = messages.build_messages(records, TEXTS, k=k, **options)
    return [(r.text, r.champion) for r in messages.message_order(found).collect()]


@pytest.mark.parametrize("seed", range(4))
def test_follows_the_rule(spark, seed):
    rng = random.Random(seed)
    matches = {}
    rows = []
    for order in range(60):
        nick = rng.choice(["Alpha#T1", "Бета#T1", "Gamma", "", None])
        row = [order, nick]
        for _ in METRICS:
            match = rng.choice(["RU_1", "RU_2", "7", "RU_3", "X_RU_4"])
            champion = matches.setdefault((nick, match), rng.choice(["A", "B", "C", "D", ""]))
            meta = rng.choice([match + "-_-" + champion] * 8 + ([match] if not champion else []))
            value = rng.choice([0, 1, 2, 5])
            row += [value, meta]
        row[2] = rng.choice([None, 0.0, float("nan"), 1.5, 4.0, 0.1])
        row[6] = rng.choice([None, True, False])
        rows.append(tuple(row))
        if rng.random() < 0.2:
            rows.append((order + 1000, *row[1:]))
    rows.sort(key=lambda row: row[0])
    assert_follows_the_rule(built(spark, rows), rows)


@pytest.mark.parametrize("seed", range(5))
def test_any_input_follows_the_rule(spark, seed):
    """Several champions for one player and match, so that cap and repeats interact."""
    rng = random.Random(100 + seed)
    rows = []
    for order in range(80):
        row = [order, rng.choice(["Alpha", "Beta"])]
        for _ in METRICS:
            champion = rng.choice(["A", "A", "A", "B", "C", "D", ""])
            row += [rng.choice([0, 1]), rng.choice(["RU_1", "RU_2", ""]) + "-_-" + champion]
        row[2] = float(row[2])
        row[6] = rng.choice([None, True])
        rows.append(tuple(row))
    k = 1 + seed % 3
    assert_follows_the_rule(built(spark, rows, k, one_champion_per_match=False), rows, k)


def test_cap_holds_over_all_players(spark):
    rows = [(i, f"p{i}", 1.0, "RU_1-_-Ahri", 1, "RU_2-_-Zed", None, None) for i in range(6)]
    texts = built(spark, rows)
    assert [c for _, c in texts].count("Ahri") == 3
    assert [t.split()[1] for t, c in texts if c == "Zed"] == ["p0", "p1", "p2"]


def test_unknown_champions_share_one_cap(spark):
    rows = [(i, f"p{i}", 1.0, None, 2, "RU_9", None, None) for i in range(4)]
    assert [c for _, c in built(spark, rows)] == ["<champion>"] * 3


def test_numbers_and_labels(spark):
    rows = [(i, f"p{i}", 1.0, f"RU_{i}-_-C{i % 50}", None, None, None, None) for i in range(200)]
    records = spark.createDataFrame(rows, SCHEMA)
    found = messages.build_messages(records, TEXTS)
    numbered = messages.number_messages(found).orderBy("pos").collect()
    assert [r.pos for r in numbered] == list(range(1, 151))
    assert [r.roster_ord for r in numbered] == sorted(r.roster_ord for r in numbered)
    assert {r.total for r in numbered} == {150}
    assert numbered[0].label == "(1/150)"


def test_cap_limits_rows_before_the_shuffle(spark):
    rows = spark.range(1000).select(
        F.concat(F.lit("c"), F.col("id") % 2).alias("champion"), F.col("id").alias("roster_ord")
    )
    capped = messages.cap_per_champion(rows, [F.col("roster_ord")])
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert capped.count() == 6


def test_texts_are_broadcast_by_their_size(spark):
    rows = [(1, "p", 1.0, "RU_1-_-A", None, None, None, None)]
    found = messages.build_messages(spark.createDataFrame(rows, SCHEMA), TEXTS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_every_metric_has_a_template():
    assert [spec.name for spec in match_metrics()] == [name for name, _ in TEMPLATES]
    assert len(TEMPLATES) == 43
    assert [s.name for s in match_metrics() if s.agg == "min"] == ["undying_ratio"]
