"""Every registered query against DuckDB on the test data, and the shape of its plan."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from clickloom.registry.queries import all_queries
from clickloom.registry.oracle import all_sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("customer", "events", "part")
NAMES = sorted(all_queries())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as from '{SF_DIR}/{table}.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


def test_every_query_has_its_sql():
    assert set(all_sql()) == set(NAMES)
    assert set(NAMES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = [tuple(row[c] for c in columns) for row in df.collect()]
    selected = ", ".join(f'"{c}"' for c in columns)
    sql = entry_point.oracle_sql()[name]
    expected = duck.execute(f"select {selected} from ({sql})").fetchall()
    assert sorted(d[0] for d in duck.execute(sql).description) == columns
    assert _sorted(found) == _sorted(expected)
    assert found


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith(("sink_", "stream_"))])
def test_plan_stays_in_the_jvm_without_cross_joins(spark, name):
    plan = entry_point.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in text


def test_plans_without_broadcast_have_no_cross_joins_either(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("top10_categories", "page_conversion", "session_extract_quota",
                     "ad_clicks_admitted", "area_top3_products"):
            df = entry_point.queries()[name](spark, SF_DIR)
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in text and "Cartesian" not in text
            assert df.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    assert entry_point.entry(spark).count() == 21
