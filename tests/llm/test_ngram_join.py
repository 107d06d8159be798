import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from matchpeaks.llm import ngram_join as j
from matchpeaks.llm.components import components, contracted
from matchpeaks.llm.hashing import shingles


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain(docs):
    sets = {d: shingle_set(t) for d, t in docs}
    least = {d: d for d in sets}

    def find(a):
        while least[a] != a:
            a = least[a]
        return a

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            least[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def near_copies(seed, families, size):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = []
    for _ in range(families):
        words = rng.choices(vocabulary, k=rng.randrange(3, 90))
        for _ in range(rng.randrange(1, size)):
            words = list(words)  # each copy is made from the one before: chains
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append(" ".join(words))
    rng.shuffle(docs)
    return [(i * 3, t.upper() if i % 7 == 0 else t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed, families, size, rounds, block", [(1, 12, 14, 3, 1 << 20), (2, 3, 60, 1, 2000), (3, 40, 3, 0, 500)])
def test_near_copies(spark, seed, families, size, rounds, block):
    docs = near_copies(seed, families, size)
    rows = j.ngram_components(spark.createDataFrame(docs, "doc_id bigint, text string"), rounds=rounds, block_bytes=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == plain(docs)


def test_long_lists_are_compared_in_parts(spark, monkeypatch):
    for name, value in (("LONG_LIST", 2), ("PART", 5)):
        monkeypatch.setattr(j, name, value)
    docs = near_copies(11, 4, 40)
    rows = j.ngram_components(spark.createDataFrame(docs, "doc_id bigint, text string"), rounds=0).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == plain(docs)


def test_shared_table(spark, documents):
    rows = j.ngram_components(spark.createDataFrame(documents, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == plain(documents)


def test_prefixes_never_lose_a_link():
    """Two sets over the threshold share at least the smaller number asked for in their prefixes."""
    rng = random.Random(6)
    for _ in range(400):
        df = {t: rng.choice([2, 2, 3, 5, 40, 1000]) for t in range(140)}
        base = rng.sample(range(100), rng.randrange(4, 90))
        one, two = (set(rng.sample(base, max(1, int(len(base) * rng.uniform(0.8, 1))))) | set(rng.sample(range(100, 140), rng.randrange(3))) for _ in range(2))
        if 100 * len(one & two) < 75 * len(one | two):
            continue
        heads, asked = [], []
        for s in (one, two):
            shared = sorted(s, key=lambda t: (df[t], t))
            ell, length = j.adaptive_prefix(np.array([df[t] for t in shared]), len(s), 75)
            heads.append(set(shared[:length]))
            asked.append(ell)
        assert len(heads[0] & heads[1]) >= min(asked)


def test_shingles_match_words():
    texts = ["a b c d e f", "a b c d e f a b c d e", "", " \t", "x", "x y", "a b c d e", "B b", "\x0ba\x1cb \x85c"]
    doc, key = shingles([t.encode().lower() for t in texts])
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(shingle_set(t)) for t in texts]
    by_key = defaultdict(set)
    for d, k in zip(doc.tolist(), key.tolist()):
        by_key[k].add(d)
    assert {0, 1, 6} in by_key.values()


def test_a_group_near_the_threshold_gives_few_edges(spark, monkeypatch):
    """1,000 texts of one origin, any two of which are about as alike as the threshold asks: edges grow with the sets."""
    rng = random.Random(21)
    origin = [f"w{i}" for i in range(100)]
    docs = []
    for i in range(1000):
        words = list(origin)
        for at in rng.sample(range(100), 2):
            words[at] = f"x{i}-{at}"
        docs.append((i, " ".join(words)))
    seen = []
    whole = j.contracted

    def counted(found, links):
        seen.append(links.count())
        return whole(found, links)

    monkeypatch.setattr(j, "contracted", counted)
    rows = j.ngram_components(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(8)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == plain(docs)
    assert sum(seen) < 4 * len(docs)


def test_components_by_and_by_are_those_of_all_edges(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(70)]
    found, schema = None, "a bigint, b bigint"
    for part in (edges[:20], edges[20:25], [], edges[25:]):
        found = contracted(found, spark.createDataFrame(part, schema))
    whole = components(spark.createDataFrame(edges, schema))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101)]
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in rows} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_one_of_each_group_stays(spark):
    docs = near_copies(7, 5, 6)
    df = spark.createDataFrame([(d, t, "x") for d, t in docs] + [(docs[0][0], docs[0][1], "x"), (None, "a b", "x")], "doc_id bigint, text string, source string")
    kept = [r["doc_id"] for r in j.keep_one(df).collect()]
    assert sorted(k for k in kept if k is not None) == sorted({c for _, c in plain(docs).values()}) and kept.count(None) == 1
