"""Every registered query agrees with its SQL on the smallest tables, and no plan compares all rows with all rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry
from check import normal
from huntspark.catalog import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.collect(), df.columns) == normal(cursor.fetchall(), columns)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_filters_reach_the_scan(spark):
    plan = QUERIES["search_alerts_aggregate"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan and "props" not in plan
    pushed = QUERIES["time_range"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in pushed
