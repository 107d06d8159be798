import random

import numpy as np
import pytest

from matchpeaks.llm import column_bwt, suffix_dedup as s


@pytest.mark.parametrize("seed", range(80))
def test_transform_against_sorted_suffixes(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(column_bwt, "CHUNK", rng.choice([3, 7, 64, 1 << 20]))
    monkeypatch.setattr(column_bwt, "SPOOL", rng.choice([1, 1 << 20]))
    tail, top = rng.choice([0, 1, 2, 3]), rng.choice([2, 3, 5])
    strings = [np.array([rng.randint(1, top) for _ in range(rng.randint(tail, tail + 9))], np.uint8) for _ in range(rng.randint(1, 8))]
    every = sorted((x[o:].tolist() + [0], i, o) for i, x in enumerate(strings) for o in range(len(x) - tail + 1))

    def common(a, b):
        return next((k for k in range(len(a)) if a[k] != b[k] or not a[k]), len(a))

    found = column_bwt.collection(strings, 6, tail)
    assert found.bwt.tolist() == [int(strings[i][o - 1]) if o else 0 for _, i, o in every]
    assert found.lcp.tolist() == [0] + [common(a[0][:-1] + [0], b[0]) if len(a[0]) <= len(b[0]) else common(b[0], a[0]) for a, b in zip(every, every[1:])]
    string, offset = column_bwt.suffixes(found, np.array(list(map(len, strings))), tail)
    assert list(zip(string.tolist(), offset.tolist())) == [(i, o) for _, i, o in every]


def plain(docs, span):
    first, out = {}, {}
    ordered = sorted((d, t.encode()) for d, t in docs)
    for d, t in ordered:
        for at in range(len(t) - span + 1):
            first.setdefault(t[at : at + span], (d, at))
    for d, t in ordered:
        gone = bytearray(len(t))
        for at in range(len(t) - span + 1):
            if first[t[at : at + span]] < (d, at):
                gone[at : at + span] = b"\1" * span
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[d] = (len(t), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), kept)
    return out


@pytest.mark.parametrize("seed, span, gram, block", [(1, 10, 3, 1 << 20), (2, 10, 4, 100), (3, 24, 8, 700), (4, 5, 5, 300), (5, 100, 24, 4000)])
def test_against_plain_search(spark, seed, span, gram, block):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(1, 3 * span))) for _ in range(14)]
    docs = [(rng.randrange(10**6), "".join(rng.choice(parts) for _ in range(rng.randrange(7)))) for _ in range(50)]
    docs = list(dict(docs).items()) + [(-1, "a" * 4 * span), (-2, "ab" * span)]
    rows = s.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string"), span, gram, block_bytes=block).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows} == plain(docs, span)


def test_shared_table(spark, documents):
    rows = s.remove_repeats(spark.createDataFrame(documents, "doc_id bigint, text string")).collect()
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows}
    assert found == plain(documents, 100) and sum(x[1] for x in found.values()) > 1000
