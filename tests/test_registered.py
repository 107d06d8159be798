import glob
import os

import duckdb
import pytest

import __spark_entry__ as registered
from check_oracle import rows_of
from matchpeaks.checks import queries
from matchpeaks.metrics import MetricSpec
from matchpeaks.operators import records

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_sql_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_its_sql(spark, duck, name):
    df = registered.queries()[name](spark, SF)
    rows = df.collect()
    if name not in registered.oracle_sql():
        assert rows
        return
    cursor = duck.execute(registered.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, rows) == rows_of(columns, cursor.fetchall())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_no_cross_join_and_no_python_rows(spark, name):
    if name.startswith(("stream", "daily", "snapshot")):
        pytest.skip("runs jobs of its own")
    plan = plan_of(registered.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "InPandas"):
        assert operator not in plan


def test_bounds_and_columns_reach_the_scan(spark):
    df = registered.queries()["weekly_ratio"](spark, SF)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(ts,2023-12-25" in plan and "LessThan(ts,2024-01-29" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in plan


def test_history_pass_stays_in_hash_aggregation(spark):
    games = queries.derived.events(spark, SF)
    specs = [MetricSpec("value"), MetricSpec("k")]
    history = records.historical_best(games, specs, "2024-01-31", table=queries.EVENTS)
    assert "HashAggregate" in plan_of(history) and "SortAggregate" not in plan_of(history)


def test_entry(spark):
    assert registered.entry(spark).count() > 0
