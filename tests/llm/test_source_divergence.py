import random
import re
from collections import Counter

import numpy as np
import pytest

from matchpeaks.llm import source_divergence as s

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, least, top):
    cut = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]) for text, lang, source in docs]
    out = []
    for lang in {c[0] for c in cut}:
        df, whole, groups = Counter(), Counter(), {}
        for of, source, words in cut:
            if of == lang:
                df.update(set(words))
                whole.update(words)
                groups.setdefault(source, Counter()).update(words)
        kept = {t for t, n in df.items() if n >= least}
        share = lambda c: (lambda n: {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept})(sum(c[t] for t in kept))
        q, p = share(whole), {source: share(c) for source, c in groups.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for source in groups:
            pairs = [(lang, source, "pair", other, sum(f(p[source][t], p[other][t]) for t in kept)) for other in groups if other != source]
            terms = [(lang, source, "term", t, f(p[source][t], q[t])) for t in kept if groups[source][t] and p[source][t] > q[t]]
            for found, last in ((pairs, len(pairs)), (terms, top)):
                out += [(*x, i + 1) for i, x in enumerate(sorted(found, key=lambda x: (-x[4], x[3].encode()))[:last])]
    return sorted(out)


@pytest.mark.parametrize("seed", range(30))
def test_pointers_are_sorted_and_runs_are_whole(seed):
    rng = random.Random(seed)
    letters = rng.choice(["ab", "aé", "abcdefgh"])
    words = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 3, 8, 9, 17, 40]))) for _ in range(rng.choice([0, 1, 30]))] * rng.choice([1, 4])
    rng.shuffle(words)
    texts = [" ".join(words[i::3]) for i in range(3)] + ["", "zz"]
    raw = [t.encode() for t in texts]
    edges = np.concatenate([[0], np.cumsum(list(map(len, raw)))])
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, lengths, doc = s.word_starts(data, edges)
    tokens = [bytes(data[a : a + n]) for a, n in zip(starts, lengths)]
    assert [t.decode() for t in tokens] == [w for t in texts for w in t.split()]
    assert doc.tolist() == [i for i, t in enumerate(texts) for _ in t.split()]
    order, sizes = s.sorted_pointers(np.concatenate([data, np.zeros(8, np.uint8)]), starts, lengths, small=rng.choice([9, 40, 5000]))
    ordered = [tokens[i] for i in order]
    assert ordered == sorted(tokens) and sizes.tolist() == [ordered.count(t) for t in sorted(set(tokens))]
    runs = np.split(order, np.cumsum(sizes)[:-1]) if len(sizes) else []
    assert all((np.diff(run) > 0).all() for run in runs)


@pytest.mark.parametrize("seed, shard, tiles", [(1, 1 << 20, (4096, 128)), (2, 40, (3, 2)), (3, 1, (1, 1)), (4, 200, (5, 3))])
def test_against_plain_counts(spark, seed, shard, tiles):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "b", "cé", "É", "longerwordthaneight", "longerwordthannine", "x_y", "北京"]
    docs = [(rng.choice([None, " ".join(rng.choices(vocabulary, range(1, 10), k=rng.randrange(8)))]), rng.choice(["l", "m", None]), rng.choice([None, "", *"stuvw"])) for _ in range(90)]
    docs += [("a b", "few", "s"), (None, "few", "t"), ("a", "single", "s")]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id bigint, text string, lang string, source string").repartition(3)
    found = s.source_divergence(df, 4, 3, shard, *tiles).collect()
    assert sorted((x["lang"], x["source"], x["part"], x["item"], x["value"], x["rank"]) for x in found) == plain(docs, 4, 3)


def test_shares_are_exact_for_counts_of_any_size(spark):
    big = 9 * 10**15
    row = spark.createDataFrame([(big, big + 7, 3)], "n bigint, total bigint, v bigint").select(s.share(*[s.F.col(c) for c in ("n", "total", "v")])).first()
    assert row[0] == 1 + 10**9 * (big + 2) // (big + 7 + 6)


def test_awkward_rows(spark, awkward, nothing):
    rows = s.source_divergence(awkward, 1).collect()
    assert {(r["lang"], r["source"], r["part"]) for r in rows} <= {("", "x", "term"), ("", "", "term")}
    assert s.source_divergence(nothing).collect() == []


def test_one_source_with_a_third_of_the_rows_and_many_sources(spark):
    docs = [("w%d common" % (i % 7), "l", "hot" if i % 3 == 0 else "s%d" % (i % 150)) for i in range(900)]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id bigint, text string, lang string, source string").repartition(4)
    found = s.source_divergence(df, 10, tile_sources=16).collect()
    assert sorted((x["lang"], x["source"], x["part"], x["item"], x["value"], x["rank"]) for x in found) == plain(docs, 10, 10)
