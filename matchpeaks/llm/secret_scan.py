"""Secrets in texts: fixed patterns, and tokens that a battery of tests takes for random.

A token (20 or more letters, digits, ``+ / _ -``) gets the smallest alphabet that
holds it: hexadecimal, letters of one case, base 32, base 36, letters, letters and digits, or base 64. Runs are cut at
``=`` inside them and at fixed-pattern spans; where no alphabet holds a part, it is cut both at ``+ /`` and at ``- _``, and of
parts that overlap the one that looks most random is kept. Tokens of digits alone are not tested. Under "each symbol is drawn
uniformly" three statistics have known laws: chi-squared of the symbol counts, the number of
runs above and below the middle of the alphabet, and the correlation of neighbours. Fisher's
method joins their p-values to one *randomness* between 0 and 1.

A token is as surprising as the share of text-like tokens of its length class and alphabet that
look at least as random, and the Benjamini-Hochberg rule in each class and alphabet keeps the
share of false discoveries below ``FDR``. Text-like tokens are a fixed model, not the corpus:
words and numbers strung together as the alphabet allows, of the class's least length (where
they look most random), whose tail is carried on by a log-normal law of Fisher's statistic. So the
rule is the same for any corpus, however few long words it holds. Lengths are kept apart
because the tests have more power on long tokens. The counts behind this are by length class, alphabet
and one of ``BINS`` levels of randomness, a fixed number of rows.

Defined results: null text counts as empty (no spans; the digest is that of the empty
string); repeated rows and null or repeated ids give one row each; tied spans are ordered by kind; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from functools import lru_cache
from statistics import fmean, stdev

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, map_texts, stored, table, texts

# The patterns of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
PART = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])|[A-Za-z0-9+/_-]{20,}")
PARTS = (re.compile(r"[A-Za-z0-9_-]{20,}={0,2}"), re.compile(r"[A-Za-z0-9+/]{20,}={0,2}"))
LEAST_TOKEN = 20
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("upper36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
)
#: Ends of the length classes, levels of randomness, and the share of false discoveries allowed.
MASK = "[SECRET]"
LENGTHS, BINS, FDR = (24, 32, 48, 64, 128), 1000, 0.05
#: What text-like tokens are made of; how many are drawn, and the number of tokens that their law is given as.
WORDS = """account address application archive available backup branch build cache category certificate change client collection
common compile component config container content context controller count create customer data database default delete deploy
description development directory document download element error event example export factory field file filter format function
generate handler header history image import index information install interface internal language library license list load local
manager member message method model module name network number object option order package page parameter password path player
position process product profile project property public query record reference release report request resource response result
return schema script search section security server service session setting source start state status storage string summary
system table target template test thread time title token transaction transfer type update upload user value version view window
anderung arbeit ausgabe beispiel benutzer bericht datei eigenschaft einheit einstellung ergebnis fehler freundschaft gesellschaft
geschwindigkeit haftpflicht krankenversicherung leitung lichkeit nachricht rechnung schaltung sicherheit sprache stellung verwaltung
werkzeug wirtschaft zeichen zusammenarbeit adresse ailleurs aujourd besoin bonjour chercher compte demande developpement donnees
ecole ensemble exemple fichier gouvernement heureusement logiciel maison moteur nouvelle ouvrage paiement quelle recherche reseau
semaine toujours utilisateur vitesse ayuntamiento busqueda ciudad conocimiento cuenta desarrollo direccion ejemplo empresa
entonces gobierno herramienta informacion lenguaje mensaje nombre pagina palabra problema proyecto pruebas respuesta seguridad
servicio siguiente tiempo trabajo usuario ventana""".split()
NULL_DRAWS, NULL_TOKENS = 1000, 10**12
FOUND = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, base array<string>, starts array<int>, ends array<int>, classes array<int>, levels array<int>"
RESULT = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint"
_NOT_TOKEN = bytes(32 if not (chr(b).isascii() and (chr(b).isalnum() or chr(b) in "+/_=-.")) else b for b in range(256))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), leftmost and without overlap inside each kind."""
    spans = []
    for m in ASSIGN.finditer(text):
        if m.end() - m.start(2) >= LEAST_ASSIGN:
            spans.append((m.start(), 0, m.end()))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= LEAST_ACCESS:
            spans.append((m.start(), 1, m.end()))
    for m in HEX.finditer(text):
        spans.append((m.start(), 2, m.end()))
    return sorted(spans)


def named(spans: list[tuple[int, int, int]]) -> list[str]:
    return [f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans]


def alphabet_of(token: str) -> str | None:
    """The smallest alphabet that holds the token; padding at its end doesn't count."""
    symbols = set(token.rstrip("="))
    return min((symbols_of for _, symbols_of in ALPHABETS if symbols <= set(symbols_of)), key=len, default=None)


def _upper_tail(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def battery(token: str, alphabet: str) -> tuple[float, float, float]:
    """p-values of uniformity, runs and serial correlation under uniform independent symbols."""
    codes = [alphabet.index(c) for c in token.rstrip("=")]
    n, k = len(codes), len(alphabet)
    if n < 2:
        return 1.0, 1.0, 1.0
    expected = n / k
    chi2 = sum((c - expected) ** 2 for c in Counter(codes).values()) / expected + (k - len(set(codes))) * expected
    df = k - 1
    # The exact variance of the statistic for n symbols, in the place of 2 * df, which holds for long tokens only.
    uniform = _upper_tail((chi2 - df) / math.sqrt(2 * df * (n - 1) / n))
    high = [2 * c >= k for c in codes]
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    runs_p = 2 * _upper_tail(abs(runs - (n + 1) / 2) / math.sqrt((n - 1) / 4))
    mean, spread = (k - 1) / 2, (k * k - 1) / 12
    serial = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:])) / (spread * math.sqrt(n - 1))
    return uniform, min(1.0, runs_p), 2 * _upper_tail(abs(serial))


def surprise(token: str, alphabet: str) -> float:
    """Fisher's statistic, halved: large if any test rejects uniform independent symbols."""
    return -sum(math.log(max(p, 1e-300)) for p in battery(token, alphabet))


def combined(x: float) -> float:
    return math.exp(-x) * (1 + x + x * x / 2)


def randomness(token: str, alphabet: str) -> float:
    """Fisher's combination: small if any test rejects uniform independent symbols."""
    return combined(surprise(token, alphabet))


def text_like(rng: random.Random, alphabet: str, n: int) -> str:
    """Words and numbers in one spelling, joined by at most one kind of mark, as far as the alphabet holds them."""
    join = rng.choice(["", *(c for c in "+/-_" if c in alphabet)])
    spell = rng.choice([str.lower, str.upper, str.title] if {"a", "A"} <= set(alphabet) else [str.lower if "a" in alphabet else str.upper])
    token = ""
    while len(token) < n:
        part = str(rng.choice([rng.randrange(10), rng.randrange(100), rng.randrange(1990, 2030)])) if rng.random() < 0.25 else spell(rng.choice(WORDS))
        token += "".join(c for c in part + join if c in alphabet)
    return token[:n]


@lru_cache(maxsize=None)
def null_law(k: int, alphabet: str) -> tuple[float, ...]:
    """For each level of randomness, the share of text-like tokens of class ``k`` at it or above."""
    rng = random.Random(f"{k} {alphabet}")
    drawn = [surprise(text_like(rng, alphabet, (LEAST_TOKEN, *LENGTHS)[k]), alphabet) for _ in range(NULL_DRAWS)]
    logs = [math.log(max(x, 1e-9)) for x in drawn]
    mean, spread = fmean(logs), stdev(logs)
    counts = Counter(min(BINS - 1, int(combined(x) * BINS)) for x in drawn)
    law, above, low = [1.0] * BINS, 0, 0.0
    for level in range(BINS - 1, 0, -1):
        above += counts[level]
        # The statistic with this randomness: ``combined`` falls from 1, so the bound only moves up.
        high = max(low, 1e-6)
        while combined(high) > level / BINS:
            high *= 2
        for _ in range(40):
            middle = (low + high) / 2
            low, high = (middle, high) if combined(middle) > level / BINS else (low, middle)
        law[level] = max(above / NULL_DRAWS, _upper_tail((mean - math.log(high)) / spread))
    # The log-normal law ends at randomness 1; its last tenth is dealt evenly, so that no chance hit there counts as a wonder.
    last = BINS * 9 // 10
    return tuple(max(p, law[last] * (BINS - level) / (BINS - last)) if level > last else p for level, p in enumerate(law))


def null_counts(family: int) -> dict[tuple[int, int, int], int]:
    """The law of a family (length class and alphabet) as numbers of ``NULL_TOKENS`` tokens."""
    law = [round(p * NULL_TOKENS) for p in null_law(family // len(ALPHABETS), ALPHABETS[family % len(ALPHABETS)][1])] + [0]
    return {(family, level, 1): law[level] - law[level + 1] for level in range(BINS) if law[level] > law[level + 1]}


def length_class(n: int) -> int:
    return sum(n >= end for end in LENGTHS)


def family_of(token: str, alphabet: str) -> int:
    """Tokens are judged among those of their length class and alphabet."""
    return length_class(len(token)) * len(ALPHABETS) + [symbols for _, symbols in ALPHABETS].index(alphabet)


def outside(start: int, end: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What is left of a run without the spans in it."""
    left = []
    for a, z in sorted(spans):
        left, start = left + [(start, a)], max(start, z)
    return [(a, z) for a, z in [*left, (start, end)] if z - a >= LEAST_TOKEN]


def tokens_in(text: str, start: int, end: int) -> list[tuple[int, int, int, int]]:
    """(start, end, family, level of randomness) of the tokens of a part without inner padding."""
    places = [(start, end)]
    if alphabet_of(text[start:end]) is None:
        places = [m.span() for pattern in PARTS for m in pattern.finditer(text, start, end)]
    rows = []
    for a, z in places:
        token = text[a:z]
        if any(map(str.isalpha, token)):
            alphabet = alphabet_of(token)
            rows.append((a, z, family_of(token, alphabet), min(BINS - 1, int(randomness(token, alphabet) * BINS))))
    kept: list[tuple[int, int, int, int]] = []
    for row in sorted(rows, key=lambda r: (-r[3], r[0])):
        if all(row[1] <= a or z <= row[0] for a, z, *_ in kept):
            kept.append(row)
    return sorted(kept)


def scan(doc_id: int | None, text: str) -> tuple:
    """Base spans and the tested tokens of a text."""
    raw = text.encode()
    long_run = any(len(run) >= LEAST_TOKEN for run in raw.translate(_NOT_TOKEN).split())
    lower = raw.lower()
    named_key = any(word in lower for word in (b"passw", b"secret", b"token", b"api"))
    spans = base_spans(text) if long_run or named_key else []
    tested = []
    for m in TOKEN.finditer(text) if long_run else ():
        near = [(max(start, m.start()), min(end, m.end())) for start, _, end in spans if start < m.end() and m.start() < end]
        for start, end in outside(m.start(), m.end(), near):
            for part in PART.finditer(text, start, end):
                tested += tokens_in(text, part.start(), part.end())
    base = named(spans)
    counts = [sum(kind == k for _, kind, _ in spans) for k in range(3)]
    digest = hashlib.sha256(",".join(base).encode()).hexdigest()
    return (doc_id, *counts, digest, base, *(list(map(list, zip(*tested))) or [[]] * 4))


def thresholds(counts: dict[tuple[int, int, int], int], fdr: float = FDR) -> dict[int, int]:
    """The least level of randomness that is a discovery, by class; classes without one are left out.

    ``counts[class, level, null]`` are numbers of tokens. A level's p-value is the share of null
    tokens at it or above, with one added to both numbers.
    """
    cut = {}
    for k in {c for c, _, null in counts if not null}:
        nulls, tokens = ({level: n for (c, level, null), n in counts.items() if c == k and null == kind} for kind in (1, 0))
        total, found, above = sum(tokens.values()), 0, 0
        for level in sorted(nulls.keys() | tokens.keys(), reverse=True):
            found, above = found + tokens.get(level, 0), above + nulls.get(level, 0)
            if (1 + above) / (1 + sum(nulls.values())) * total <= fdr * found:
                cut[k] = level
    return cut


def cut_levels(rows: DataFrame, fdr: float) -> dict[int, int]:
    each = rows.select(F.explode(F.arrays_zip("classes", "levels")).alias("t")).groupBy("t.classes", "t.levels").count()
    counts = {(r[0], r[1], 0): r[2] for r in each.collect()}
    for family in {f for f, _, _ in counts}:
        counts |= null_counts(family)
    return thresholds(counts, fdr)


def secret_scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """Spans of every document; what the scan keeps is small and stored, and so the texts are read once."""
    rows = stored(map_texts(texts(docs), scan, FOUND), "secrets")
    cut = cut_levels(rows, fdr)

    def spans(doc_id, _text, assign, access, hexes, digest, base, starts, ends, classes, levels):
        found = [(s, 3, e) for s, e, c, level in zip(starts, ends, classes, levels) if level >= cut.get(c, BINS)]
        known = [(int(s), KINDS.index(kind), int(e)) for kind, s, e in (x.split(":") for x in base)]
        return doc_id, assign, access, hexes, digest, ",".join(named(sorted(known + found))), len(found)

    columns = ["doc_id", F.lit("").alias("text"), *[c.split()[0] for c in FOUND.split(", ")[1:]]]
    return map_texts(rows.select(*columns), spans, RESULT)


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """``text`` with its spans replaced; spans that overlap make one."""
    parts, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, fdr: float = FDR, mask: str = MASK) -> DataFrame:
    """The documents with every secret masked; ``n_chars``, where there is one, follows the text."""
    cut = cut_levels(stored(map_texts(texts(docs), scan, FOUND), "secrets"), fdr)

    def row(text: str) -> tuple[str, bool]:
        _, *_, base, starts, ends, classes, levels = scan(None, text)
        found = [(s, e) for s, e, c, level in zip(starts, ends, classes, levels) if level >= cut.get(c, BINS)]
        found += [(int(s), int(e)) for _, s, e in (x.split(":") for x in base)]
        return masked(text, found, mask), bool(found)

    rows, names = add_columns(docs, row, "clean string, changed boolean")
    columns = {"text": F.when(F.col(names["changed"]), F.col(names["clean"])).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col(names["changed"]), F.length(names["clean"])).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))
