import math
import random
from collections import Counter

import pytest

from matchpeaks.llm import backoff_scores as b


def plain(docs, order, discount):
    words = [t.encode().lower().split() for _, t in docs]
    own = [Counter(tuple(w[j : j + k]) for k in range(1, order + 1) for j in range(len(w) - k + 1)) for w in words]
    total = sum(own, Counter())
    for w, o in zip(words, own):
        rest, score, used = sum(map(len, words)) - len(w), 0.0, [0] * (order + 1)
        for j in range(len(w)):
            top = min(order, j + 1)
            for k in range(top, 0, -1):
                gram = tuple(w[j - k + 1 : j + 1])
                if n := total[gram] - o[gram]:
                    score += math.log(n / (total[gram[:-1]] - o[gram[:-1]] if k > 1 else rest))
                    break
            else:
                k = 1
                used[0] += 1
                score += math.log(1 / max(1, rest))
            score += (top - k) * math.log(discount)
            used[k] += bool(n)
        yield len(w), score, used


@pytest.mark.parametrize("order, block", [(1, 1 << 20), (2, 50), (3, 300), (4, 1 << 20)])
def test_against_plain_counts(spark, order, block):
    rng = random.Random(order)
    docs = [(i, " ".join(rng.choice("a b c dd E e f g h".split()) for _ in range(rng.randrange(12)))) for i in range(60)]
    rows = {r["doc_id"]: r for r in b.backoff_scores(spark.createDataFrame(docs, "doc_id bigint, text string"), order, 0.3, block).collect()}
    for (doc_id, _), (n, score, used) in zip(docs, plain(docs, order, 0.3)):
        row = rows[doc_id]
        assert row["n_words"] == n and row["log_score"] == pytest.approx(score)
        assert row["n_known"] == used[1:] and row["n_unknown"] == used[0]


def test_one_document_knows_nothing(spark):
    row = b.backoff_scores(spark.createDataFrame([(1, "a b a b")], "doc_id bigint, text string")).first()
    assert row["n_unknown"] == 4
