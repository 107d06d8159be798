import hashlib
import random

import numpy as np
import pytest

from matchpeaks.llm import substring_dedup as s
from matchpeaks.llm.hashing import word_hashes


def plain(docs, width):
    """Window by window, without hashes."""
    cut = [(d, (t or "").encode().split()) for d, t in docs]
    least = {}
    for d, words in cut:
        for at in range(len(words) - width + 1):
            if d is not None:
                key = tuple(words[at : at + width])
                least[key] = min(least.get(key, d), d)
    out = []
    for d, words in cut:
        gone = set()
        for at in range(len(words) - width + 1):
            if d is not None and least[tuple(words[at : at + width])] < d:
                gone |= set(range(at, at + width))
        out.append((d, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed, width, block, size", [(1, 3, 1 << 20, None), (2, 3, 60, None), (3, 2, 200, (3, 2)), (4, 13, 500, (1, 64)), (5, 1, 90, None)])
def test_against_plain_search(spark, seed, width, block, size):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice(["a", "b", "Ä", "dé", "e\x1cf"]) for _ in range(rng.randrange(1, 3 * width))) for _ in range(12)]
    docs = [(rng.choice([None, rng.randrange(40)]), rng.choice(["\n", " ", "\t\x0b"]).join(rng.choice(passages) for _ in range(rng.randrange(6)))) for _ in range(60)]
    docs += [(7, None), (None, ""), (3, " \n")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert rows_of(s.remove_repeated_windows(df, width, block, size)) == plain(docs, width)


def test_shared_table(spark, documents):
    found = rows_of(s.remove_repeated_windows(spark.createDataFrame(documents, "doc_id bigint, text string"), block_bytes=30_000))
    assert found == plain(documents, s.WINDOW) and sum(x[2] for x in found) > 500


def test_a_window_that_all_documents_hold(spark):
    passage = " ".join(f"shared{i}" for i in range(15))
    docs = [(i, f"{passage} own{i}") for i in range(3000)]
    found = rows_of(s.remove_repeated_windows(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7), block_bytes=20_000))
    assert {(n, removed) for d, n, removed, _ in found if d} == {(16, 15)} and (0, 16, 0, docs[0][1]) in found


def test_estimates_are_never_too_low():
    """Every window that two documents hold is let through, however small the sketch."""
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64))
    for cells in (1, 7, 64, 4096):
        parts = [np.sort(rng.choice(keys, 200, replace=False)) for _ in range(4)]
        lists = [s.cell_lists(part, cells) for part in parts]
        sent = [s.squeeze_sorted(at.astype(np.uint64)) for at, _ in lists]
        ones = [s.zstandard.compress(np.ones(len(at), np.uint8).tobytes()) for at, _ in lists]
        times = {k: sum(k in set(p.tolist()) for p in parts) for k in keys.tolist()}
        let_through = 0
        for part, (at, where), reply in zip(parts, lists, s._merge(cells)(sent, ones)):
            often = np.unpackbits(np.frombuffer(s.zstandard.decompress(reply), np.uint8), count=len(at)).astype(bool)
            estimate = often[where].all(axis=0)
            assert all(e for k, e in zip(part.tolist(), estimate) if times[k] > 1)
            let_through += sum(e for k, e in zip(part.tolist(), estimate) if times[k] == 1)
        assert cells < 4096 or let_through < 30


def test_hashes_tell_periodic_words_apart():
    """Two strings that every polynomial modulo a power of two takes for equal."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    _, hashes = word_hashes([one.encode(), other.encode()])
    assert hashes[0] != hashes[1]


def test_awkward_rows(spark, awkward, nothing):
    rows = {r["doc_id"]: r for r in s.remove_repeated_windows(awkward, 2).collect() if r["doc_id"] is not None}
    assert (rows[1]["n_words"], rows[1]["kept"]) == (0, "") and rows[3]["n_words"] == 0
    assert rows[5]["n_removed"] == 0  # rows of one id don't remove each other's words
    assert rows[4]["n_words"] == 60_000 and rows[6]["kept"].split(" ") == ["é", "ß", "\x00", "\u2028", "😀", "one"]
    assert s.remove_repeated_windows(nothing).collect() == []


def test_query_gives_digests(spark):
    row = s.op11_substring_dedup(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").first()["text"]
    assert row["kept_sha256"] == hashlib.sha256(" ".join(text.split()).encode()).hexdigest()
