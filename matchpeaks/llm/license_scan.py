"""Licence notices: an Aho-Corasick automaton finds phrases and tags, a shunting-yard parser reads their expressions.

The words of a text (ASCII letters and digits in lower case, and all other characters) are joined by single spaces,
so that one automaton over ``" phrase "`` finds every place of consecutive words. Where a
text holds the identifier tag, the rest of its line is an expression: identifiers with
``and``, ``or``, ``with`` and brackets. Notices that are joined by such a word ("... the MIT
License or the Apache License") make an expression in the same way.

An expression is evaluated for what it asks of a user, from 0 (nothing) to 4 (no commercial
use): ``and`` takes the stricter side, ``or`` the milder, ``with`` an exception one step less
than its licence. Labels are the identifiers and notices that occur.

``score`` says how sure the labels are: 1 for a tag with a readable expression, 0.9 for a
base phrase, 0.6 for another notice, 0 for none.

Defined results: null text counts as empty (no words, no labels, score 0); repeated rows and null
or repeated ids give one row each; an unreadable expression gives the labels of its known
identifiers; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from .common import map_texts, table, texts

# The base phrases and labels of the contract.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further notices.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "boost",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
TAGGED = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
#: What a licence asks of a user, by the beginning of its identifier; the longest that fits counts, others ask 1.
STRICTNESS = {"public-domain": 0, "cc0": 0, "unlicense": 0, "0bsd": 0, "mpl": 2, "epl": 2, "lgpl": 2, "cc-by-sa": 2, "gpl": 3, "agpl": 3, "cc-by-nd": 3, "cc-by-nc": 4, "proprietary": 4}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
SCHEMA = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, expression string, strictness int"
_ATOM = re.compile(r"[()]|[^\s()]+")
#: Bytes to words: A-Z to lower case, other ASCII that is no letter or digit to a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands and operators in evaluation order. ValueError if the expression is broken."""
    out: list[str] = []
    waiting: list[str] = []
    operand = True
    for token in tokens:
        if (token in PRECEDENCE or token == ")") == operand:
            raise ValueError(f"unexpected {token}")
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ValueError("bracket closed but not opened")
            waiting.pop()
        elif token in PRECEDENCE:
            while waiting and PRECEDENCE.get(waiting[-1], 0) >= PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        else:
            out.append(token)
            operand = False
    if operand or "(" in waiting:
        raise ValueError("expression ends early")
    return out + waiting[::-1]


def strictness(name: str) -> int:
    fits = [begin for begin in STRICTNESS if name.startswith(begin)]
    return STRICTNESS[max(fits, key=len)] if fits else 1


def evaluate(tokens: list[str]) -> tuple[str, int]:
    """The normal form of an expression and what it asks of a user."""
    stack: list[tuple[str, int]] = []
    for token in postfix(tokens):
        if token not in PRECEDENCE:
            stack.append((token, strictness(token)))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        asks = {"and": max(left, right), "or": min(left, right), "with": max(0, left - 1)}[token]
        stack.append((f"{a} with {b}" if token == "with" else f"({a} {token} {b})", asks))
    return stack[0]


def atoms(tokens: list[str]) -> list[str]:
    """Licence identifiers: operands but for the exceptions after ``with``."""
    return [t for before, t in zip(["", *tokens], tokens) if t not in PRECEDENCE and t not in "()" and before != "with"]


def tagged(text: str) -> Iterator[list[str]]:
    for m in TAGGED.finditer(text):
        tokens = [t.lower().rstrip(",;*/") for t in _ATOM.findall(m[1])]
        tokens = [t for t in tokens if t]
        while tokens:  # what follows an expression on its line is no part of it
            try:
                postfix(tokens)
                break
            except ValueError:
                tokens.pop()
        if tokens:
            yield tokens


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def joined(words: list[bytes], places: list[tuple[int, str]]) -> list[str]:
    """An expression from notices: those that a joining word ties together; longer notices hide what they hold."""
    spans: list[tuple[int, int, str]] = []
    for start, phrase in sorted(places, key=lambda p: (p[0], -len(p[1]))):
        if phrase != TAG and (not spans or start >= spans[-1][1]):
            spans.append((start, start + phrase.count(" ") + 1, phrase))
    tokens: list[str] = []
    end = None
    for start, after, phrase in spans:
        name = (BASE | NOTICES)[phrase]
        near = words[end:start] if end is not None and start - end <= 4 else []
        between = [w.decode() for w in near if w in (b"and", b"or")]
        if len(between) == 1:
            tokens += [between[0], name]
        else:
            tokens += ["and", name] if tokens else [name]
        end = after
    return tokens


def scan(doc_id: int | None, text: str, found: ahocorasick.Automaton) -> tuple:
    words = words_of(text)
    line = f" {b' '.join(words).decode()} "
    places, at, word = [], 0, 0
    for end, phrase in found.iter(line):
        start = end - len(phrase) - 1
        word, at = word + (line.count(" ", at, start) if start >= at else -line.count(" ", start, at)), start
        places.append((word, phrase))
    base = sorted(start for start, phrase in places if phrase in BASE)
    base_labels = {BASE[phrase] for _, phrase in places if phrase in BASE}
    labels = base_labels | {NOTICES[phrase] for _, phrase in places if phrase in NOTICES}
    tags = list(tagged(text)) if any(phrase == TAG for _, phrase in places) else []
    for tokens in tags:
        labels |= set(atoms(tokens))
    tokens = [t for i, tag in enumerate(tags) for t in (["and"] * (i > 0) + ["(", *tag, ")"])] or joined(words, places)
    expression, asks = evaluate(tokens) if tokens else (None, None)
    score = 1.0 if tags else 0.9 if base else 0.6 if labels else 0.0
    edge = (base[0], base[-1]) if base else (None, None)
    return doc_id, len(words), len(base), *edge, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, expression, asks


def license_scan(docs: DataFrame) -> DataFrame:
    return map_texts(texts(docs), scan, SCHEMA, automaton)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
