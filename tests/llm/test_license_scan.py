import re

import pytest

from matchpeaks.llm import license_scan as s


def test_base_against_plain_search(spark, documents):
    extra = [(10_001, "MIT License mit license, CC-BY; cc by"), (10_002, "gnu general\npublic LICENSE Apache   licenseé"), (10_003, "the smit license")]
    rows = {r["doc_id"]: r for r in s.license_scan(spark.createDataFrame(documents + extra, "doc_id bigint, text string")).collect()}
    some = 0
    for doc_id, text in documents + extra:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        places = [(i, label) for phrase, label in s.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        row = rows[doc_id]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        edge = (min(places)[0], max(places)[0]) if places else (None, None)
        assert (row["first_word"], row["last_word"]) == edge
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        some += len(places)
    assert some > 7


@pytest.mark.parametrize(
    "text, expected",
    [
        ("mit or apache-2.0 and gpl-3.0", ("(mit or (apache-2.0 and gpl-3.0))", 1)),
        ("( mit or apache-2.0 ) and gpl-3.0", ("((mit or apache-2.0) and gpl-3.0)", 3)),
        ("gpl-2.0 with classpath or mit", ("(gpl-2.0 with classpath or mit)", 1)),
        ("gpl-2.0 with classpath", ("gpl-2.0 with classpath", 2)),
    ],
)
def test_expressions(text, expected):
    assert s.evaluate(text.split()) == expected


@pytest.mark.parametrize("text", ["", "and", "mit or", "( mit", "mit )", "mit mit", "with mit"])
def test_broken_expressions(text):
    with pytest.raises(ValueError):
        s.postfix(text.split())


def test_tags_and_notices():
    found = s.automaton()
    row = s.scan(1, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause WITH thing */\ncode", found)
    assert row[6] == "apache-2.0,bsd-3-clause,mit" and row[7] == 1.0 and row[9] == 1
    row = s.scan(1, "SPDX-License-Identifier: GPL-2.0 OR (broken", found)
    assert row[6] == "gpl-2.0"
    row = s.scan(1, "under the MIT License or the Mozilla Public License", found)
    assert row[5:] == ("mit", "mit,mpl", 0.9, "(mit or mpl)", 1)
    assert s.scan(1, "nothing here", found)[2:] == (0, None, None, "", "", 0.0, None, None)
