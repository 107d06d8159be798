import hashlib
import random
import re
from collections import Counter

from matchpeaks.llm import secret_scan as s


def test_base_spans_against_plain_search(spark, documents):
    """Kinds are searched one by one in the whole text; position by position for the fixed alphabets."""
    given = ["é password = 'a/b+c.d=e-f_' Secret:12345", "AKIA" + "Z9" * 8 + "x", "AKIAAKIA" + "Q" * 20, "f" * 23 + "g" + "0f" * 12 + "é" + "a" * 24, "token==abcdef0123456789abcdef0123"]
    documents = documents + list(enumerate(given, 10_000))
    rows = {r["doc_id"]: r for r in s.secret_scan(spark.createDataFrame(documents, "doc_id bigint, text string")).collect()}
    assign = re.compile("(?i:password|passwd|secret|token|api_?key)[\"']?[ ]*[:=][ ]*[\"']?([A-Za-z0-9+/_.=-]+)")
    some = 0
    for doc_id, text in documents:
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 6]
        at = 0
        while (at := text.find("AKIA", at)) >= 0:
            end = at + 4
            while end < len(text) and re.match("[A-Z0-9]", text[end]):
                end += 1
            if end > at + 4:
                spans += [(at, 1, end)] * (end - at >= 20)
                at = end
            else:
                at += 1
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        named = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in sorted(spans))
        assert rows[doc_id]["base_sha256"] == hashlib.sha256(named.encode()).hexdigest()
        assert [rows[doc_id][c] for c in ("n_assign", "n_access", "n_hex")] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        some += len(spans)
    assert some > 5


def test_rules_of_the_patterns():
    text = "Token: 'abc' API_KEY=a1b2c3 my_secret := ab.cd-ef password==x AKIA" + "A" * 16 + " akia"
    assert [text[a:z] for a, _, z in s.base_spans(text)] == ["API_KEY=a1b2c3", "AKIA" + "A" * 16]


def test_battery_has_the_stated_laws():
    """Under uniform symbols each p-value is below 5 % about one time in twenty."""
    rng = random.Random(5)
    for _, alphabet in s.ALPHABETS:
        for n in (32, 64):
            tests = [s.battery("".join(rng.choices(alphabet, k=n)), alphabet) for _ in range(400)]
            for p in zip(*tests):
                assert 0.01 < sum(x < 0.05 for x in p) / 400 < 0.1
            assert sum(s.randomness("".join(rng.choices(alphabet, k=n)), alphabet) < 0.05 for _ in range(400)) / 400 < 0.12


def test_random_tokens_stand_out_of_words(spark):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    words = [" ".join("".join(rng.choice(["the", "ing", "tion", "er"]) for _ in range(rng.randrange(8, 16))) for _ in range(20)) for _ in range(60)]
    keys = ["".join(rng.choices(letters, k=40)) for _ in range(40)]
    plain = ["aaaa1111" * 4 for _ in range(3)]
    rows = [(i, w) for i, w in enumerate(words)] + [(100 + i, f"see {k} there") for i, k in enumerate(keys)] + [(200 + i, p) for i, p in enumerate(plain)]
    found = {r["doc_id"]: r for r in s.secret_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum(found[100 + i]["n_random"] for i in range(40)) >= 36
    assert sum(r["n_random"] for d, r in found.items() if d < 100 or d >= 200) <= 2
    assert found[100]["spans"] in ("random:4:44", "")


def test_thresholds_against_plain_benjamini_hochberg():
    rng = random.Random(2)
    for _ in range(200):
        nulls = [rng.randrange(20) for _ in range(rng.randrange(60))]
        tokens = [rng.randrange(10, 40) for _ in range(rng.randrange(1, 40))]
        counts = Counter((0, n, 1) for n in nulls) + Counter((0, t, 0) for t in tokens)
        p = {t: (1 + sum(n >= t for n in nulls)) / (1 + len(nulls)) for t in tokens}
        passed = [t for t in tokens if p[t] <= 0.2 * sum(p[u] <= p[t] for u in tokens) / len(tokens)]
        found = sorted(t for t in tokens if t >= s.thresholds(counts, 0.2).get(0, 99))
        assert found == sorted(t for t in tokens if passed and p[t] <= max(map(p.get, passed)))


def test_masking(spark):
    df = spark.createDataFrame([(1, "a token=abcdef1 b", 17), (2, "clean", 99)], "doc_id bigint, text string, n_chars bigint")
    assert [tuple(r) for r in s.redact(df).orderBy("doc_id").collect()] == [(1, "a [SECRET] b", 12), (2, "clean", 99)]
    assert s.masked("0123456789", [(2, 5), (4, 7), (8, 9)], "#") == "01#7#9"


def test_keys_are_found_without_long_words(spark):
    """A few keys of every length and alphabet, in a corpus without a single long word."""
    rng = random.Random(7)
    rows = []
    for n in (28, 40, 56, 80, 140):
        for name in ("base62", "base64", "HEX"):
            symbols = dict(s.ALPHABETS)[name]
            rows += [(len(rows) + i, "a short text " + "".join(rng.choices(symbols, k=n)) + " ends") for i in range(4)]
    found = s.secret_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sum(r["n_random"] for r in found) >= 0.9 * len(rows)
    masked = s.redact(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sum(r["text"] == "a short text [SECRET] ends" for r in masked) >= 0.85 * len(rows)


def test_null_law_holds_for_text_like_tokens():
    """Fresh text-like tokens are as rarely random as the law says, up to chance."""
    rng = random.Random(8)
    for _, alphabet in s.ALPHABETS:
        for k, n in enumerate((s.LEAST_TOKEN, *s.LENGTHS[:3])):
            levels = [int(s.randomness(s.text_like(rng, alphabet, n), alphabet) * s.BINS) for _ in range(300)]
            law = s.null_law(k, alphabet)
            assert all(x >= y for x, y in zip(law, law[1:]))
            for level in (10, 100, 500):
                assert sum(x >= level for x in levels) / 300 <= law[level] + 4 * (law[level] / 300) ** 0.5 + 0.01


def test_keys_in_assignments_and_keys_of_letters(spark):
    """Keys after an inner "=", beside marks of another alphabet, after a fixed pattern, and without a digit."""
    rng = random.Random(9)
    symbols = dict(s.ALPHABETS)
    forms = [("AWS_KEY={}", "base64"), ("sid={}", "base62"), ("a/b+c/{}", "base64url"), ("my-key_{}", "base64"), ("{}==", "base64"), ("{}", "letters"), ("AKIA" + "Q" * 20 + "-{}", "base62"), ("x=1&id={}&b=2", "upper")]
    rows = []
    for i in range(80):
        form, name = forms[i % len(forms)]
        key = "".join(rng.choices(symbols[name], k=56))
        rows.append((i, f"see {form.format(key)} there"))
    found = {r["doc_id"]: r for r in s.secret_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for at in range(len(forms)):
        assert sum(found[i]["n_random"] >= 1 for i in range(at, 80, len(forms))) >= 8, forms[at]
    assert [text[a:z] for text in ["NAME=" + "aB3" * 10 + "=="] for a, z, *_ in zip(*s.scan(1, text)[-4:])] == ["aB3" * 10 + "=="]
