import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from matchpeaks.llm import decontaminate as d

WORDS = "the of anthe oner sted inges hathe er wasthe only forti shnd reble eanor thin ouan tionly".split()


def least_distance(piece, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(piece, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != t)))
        row = new
    return min(row)


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + rng.choice("xyz") + text[at:], text[:at] + rng.choice("xyz") + text[at + 1 :]])
    return text


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed"]) for _ in range(n))


@pytest.mark.parametrize("seed", range(4))
def test_against_the_whole_edit_matrix(spark, seed):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.randrange(2, 30))) for i in range(8)] + [(90, "tiny"), (91, ""), (92, "Été  à\tla mer, plage " * 4)]
    docs = []
    for i in range(30):
        item = rng.choice(items)[1]
        inside = edited(rng, item, rng.randrange(0, max(1, len(item) // 6))) if item and rng.random() < 0.7 else ""
        docs.append((i, f"{prose(rng, rng.randrange(40))} {inside.upper()}\n{prose(rng, rng.randrange(40))}"))
    docs += [(100, items[0][1][10:]), (101, items[1][1] * 2), (102, "")]
    expected = set()
    for item, text in items:
        parts = d.pieces_of([(item, text)])
        for doc, whole in docs:
            whole = d.normal(whole)
            codes = ["".join(map(chr, c)) for c in parts.codes]
            if any(least_distance(c, whole) <= k for c, k in zip(codes, parts.budgets)) or any(s in whole for _, s in parts.short):
                expected.add((doc, item))
    a, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    rows = d.find_leaks(a, b, part_chars=400).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == expected and len(rows) == len(expected) > 5
    kept = {r["doc_id"] for r in d.keep_clean(a, b, part_chars=400).collect()}
    assert kept == {x for x, _ in docs} - {x for x, _ in expected}


def test_lemma_keeps_every_leak():
    """Bands are judged by counted q-grams; none within the edit budget may fall below the bound."""
    rng = random.Random(9)
    for _ in range(150):
        piece = prose(rng, 30)[:100]
        p = d.pieces_of([(1, piece)])
        text = prose(rng, 20) + edited(rng, d.normal(piece), int(p.budgets[0])) + prose(rng, 20)
        codes = d.code_points(text)
        assert d.candidates(codes, p, d.Q)


def test_banded_distance():
    rng = random.Random(10)
    for _ in range(60):
        piece, text = prose(rng, 6)[:40], prose(rng, 20)
        rows = np.array([d.code_points(piece)])
        cost, _ = d.banded(rows, np.array([len(piece)]), d.code_points(text), np.array([-len(piece)]), len(text) + 2 * len(piece))
        assert cost[0] == least_distance(piece, text)


@pytest.mark.parametrize("n", [60, 75, 90, 100, 110, 120])
def test_passages_at_all_offsets_of_an_item(n):
    """A copied passage of 60 or more characters is found wherever it begins."""
    rng = random.Random(n)
    item = d.normal(prose(rng, 80))
    p = d.pieces_of([(1, item)])
    at = range(len(item) - n + 1)
    docs = [d.normal(f"{prose(rng, 12)}{item[i : i + n]}{prose(rng, 12)}") for i in at]
    assert {doc for doc, *_ in d.leaks_in(list(at), docs, p)} == set(at)


def test_rounds_are_bounded_by_characters(monkeypatch):
    """Long documents share no round of array work: memory goes by characters, not by rows."""
    text = prose(random.Random(5), 16_000)
    rows = [(n, text) for n in range(40)] + [(40, None), (41, "")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["doc_id", "text"])
    leaks_in, sizes = d.leaks_in, []

    def counted(ids, held, *more):
        sizes.append(sum(map(len, held)))
        return leaks_in(ids, held, *more)

    monkeypatch.setattr(d, "leaks_in", counted)
    monkeypatch.setattr(d, "_parts", lambda *_: [SimpleNamespace(value=d.pieces_of([(1, "no such passage in any of these texts, whatever is done")]))])
    docs = SimpleNamespace(columns=["doc_id", "text"], schema=None, mapInArrow=lambda run, schema: run(iter([batch])))
    kept = pa.Table.from_batches(d.keep_clean(docs, None))
    assert kept["doc_id"].to_pylist() == [n for n, _ in rows]
    assert max(sizes) < 1 << 20
