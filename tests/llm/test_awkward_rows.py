"""Every operator on documents gives its defined result for awkward rows, and none for an empty table."""

import hashlib

import pytest

from matchpeaks.llm import backoff_scores, byte_bpe, decontaminate, license_scan, ngram_join, quality_rules, secret_scan, suffix_dedup

EMPTY = hashlib.sha256(b"").hexdigest()


def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 1, None), (5, None, 0)], "doc_id bigint, quality int, toxic int")


OPERATORS = {
    "secrets": lambda spark, df: secret_scan.secret_scan(df),
    "scores": lambda spark, df: backoff_scores.backoff_scores(df),
    "licences": lambda spark, df: license_scan.license_scan(df),
    "components": lambda spark, df: ngram_join.ngram_components(df),
    "ids": lambda spark, df: byte_bpe.encode(df),
    "quality": lambda spark, df: quality_rules.quality_rules(df, labels(spark)),
    "kept": lambda spark, df: suffix_dedup.remove_repeats(df),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_each(spark, awkward, nothing, name):
    rows = OPERATORS[name](spark, awkward).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(["1", "2", "3", "4", "5", "5", "None", "None", "6", "7"])
    assert OPERATORS[name](spark, nothing).collect() == []


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def test_secrets_of_nothing(awkward):
    rows = by_id(secret_scan.secret_scan(awkward))
    assert rows[1]["base_sha256"] == rows[2]["base_sha256"] == EMPTY and rows[1]["spans"] == ""


def test_components_of_awkward_rows(awkward):
    rows = ngram_join.ngram_components(awkward).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] in (1, 2, 3, 5, 7)} == {(1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 1, 5), (7, 1, 7)}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None, None]


def test_scores_of_awkward_rows(awkward):
    rows = by_id(backoff_scores.backoff_scores(awkward))
    assert rows[1]["log_score"] == 0.0 and rows[1]["mean_log_score"] is None
    assert rows[5]["n_known"] == [1, 1, 3] and rows[5]["n_unknown"] == 0


def test_kept_bytes_of_awkward_rows(awkward):
    rows = by_id(suffix_dedup.remove_repeats(awkward, span=8, gram=3))
    assert rows[5]["n_removed"] == 0  # rows of one id start at the same place
    assert rows[1]["n_bytes"] == 0 and bytes(rows[6]["kept"]).decode() == "é ß \x00   😀 one"


def test_row_keeping_forms(spark, awkward, nothing):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "only forti"), (None, "x" * 200)], "item_id bigint, text string")
    assert len(quality_rules.keep_good(awkward, labels(spark)).collect()) == 1
    assert ngram_join.keep_one(awkward).count() == 9
    assert decontaminate.keep_clean(awkward, items).count() == 10
    masked = secret_scan.redact(awkward)
    assert masked.schema == awkward.schema and masked.count() == 10
    for df in (quality_rules.keep_good(nothing, labels(spark)), ngram_join.keep_one(nothing), decontaminate.keep_clean(nothing, items), secret_scan.redact(nothing)):
        assert df.columns == awkward.columns and df.count() == 0
    assert decontaminate.find_leaks(awkward, items.limit(0)).collect() == []
    assert decontaminate.find_leaks(nothing, items).collect() == []
