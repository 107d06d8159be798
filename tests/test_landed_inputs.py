"""Inputs that the registered queries land for the daily jobs and the stream."""

import datetime as dt
import pathlib

import pytest

from matchpeaks.checks import derived, queries

START = dt.datetime(2024, 1, 1, 12)


@pytest.fixture
def sf_dir(spark, tmp_path):
    kinds = ["view", "error", "signup", "click"]
    rows = [
        (n, START + dt.timedelta(days=n % 5), n % 7, kinds[n % 4], float(n), '{"k": %d}' % (n % 100))
        for n in range(400)
    ]
    rows += [rows[3], (None, START, 1, "click", 1.0, '{"k": 1}'), (401, None, 1, "click", 1.0, None)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("where, later", [("true", 0), ("event_id % 3 = 0", 3)])
def test_documents_dealt_out_by_day_are_the_same(spark, sf_dir, tmp_path, where, later):
    plain = derived.documents(spark, sf_dir).where(where).selectExpr("text", f"date_add(load_date, {later}) as load_date")
    wanted = sorted(map(tuple, plain.collect()), key=str)
    dealt = derived.documents(spark, sf_dir, 100, days_later=later, where=where).select("text", "load_date")
    assert len(wanted) > 100 and sorted(map(tuple, dealt.collect()), key=str) == wanted
    for _ in range(2):
        queries._file(spark, sf_dir, f"{tmp_path}/landing", where=where, days_later=later)
    files = [f for f in pathlib.Path(f"{tmp_path}/landing").rglob("part-*")]
    assert files and all(f.name.endswith(".txt.gz") for f in files)
    landed = spark.read.schema("value string, load_date date").text(f"{tmp_path}/landing")
    assert sorted(map(tuple, landed.collect()), key=str) == sorted(wanted * 2, key=str)


def test_text_is_made_after_the_shuffle(spark, sf_dir):
    found = derived.documents(spark, sf_dir, 100).select("text", "load_date")
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    texts = [n for n, line in enumerate(lines) if "StructsToJson" in line]
    assert texts and max(texts) < min(n for n, line in enumerate(lines) if "Exchange" in line)
