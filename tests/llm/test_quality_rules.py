import math
import random
import re
from collections import Counter

from matchpeaks.llm import quality_rules as q


def test_base_counts(spark, documents):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    df = spark.createDataFrame([(d, t, "en") for d, t in documents], "doc_id bigint, text string, lang string")
    rows = {r["doc_id"]: r for r in q.quality_rules(df, labels).collect()}
    for doc_id, text in documents:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        row = rows[doc_id]
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside))
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        assert row["base_failed"] == failed and row["kept"] == (not failed)  # no labels, no cutoffs


def test_binomial_tail_is_exact():
    for n in (1, 5, 40, 300):
        for rate in (0.01, 0.1, 0.5, 0.9):
            total = 0.0
            for k in range(n + 1):
                total += math.comb(n, k) * rate**k * (1 - rate) ** (n - k)
                assert abs(q.binomial_below(k, n, rate) - total) < 1e-9


def test_cutoffs_keep_their_promise():
    """In repeated holdouts the true false-rejection rate of what is chosen stays in the budget."""
    rng, broken = random.Random(4), 0
    for _ in range(40):
        counts = Counter()
        for quality in [1] * 3000 + [0] * 1000:
            counts["en", "symbols", min(10, int(rng.betavariate(1, 6 if quality else 2) * 11)), quality] += 1
        chosen = q.choose(counts, ("en",), ("symbols",), tuple(i / 10 for i in range(10)), 0.05, 0.05)
        if chosen:
            level = [i / 10 for i in range(10)].index(chosen["en", "symbols"])
            broken += (1 - (level + 1) / 11) ** 6 > 0.05
    assert broken <= 4
    assert q.choose(Counter({("en", "symbols", 0, 1): 30, ("en", "symbols", 9, 0): 30}), ("en",), ("symbols",)) == {}  # too few labels


def test_bad_documents_go_and_good_ones_stay(spark):
    good, bad = "plain words of a good text that goes on for a while here", "bad*** words### of$$$ junk%%% that*** goes### on$$$ for%%% a while***"
    docs = [(i, f"{good} {i}", "en") for i in range(1500)] + [(2000 + i, f"{bad} {i}", "en") for i in range(300)]
    labels = [(i, 1) for i in range(1200)] + [(2000 + i, 0) for i in range(200)]
    df, marks = spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, quality int")
    kept = {r["doc_id"] for r in q.quality_rules(df, marks).where("kept").collect()}
    assert kept == set(range(1500))
    assert {r["doc_id"] for r in q.keep_good(df, marks).collect()} == kept
