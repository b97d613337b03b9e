"""Every registered query against DuckDB, on the smallest test data."""

import __spark_entry__ as entry_points
import duck
import pandas as pd
import pytest
from tidemark.plans.oracle import ORACLE
from tidemark.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck.connect(FOLDER)


def test_entry_has_rows(spark):
    found = entry_points.entry(spark)
    assert found.columns[:3] == ["customer_id", "name", "email"] and found.count() > 0


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_duckdb(spark, con, name):
    ours = entry_points.queries()[name](spark, FOLDER)
    assert duck.differences(ours, con, entry_points.oracle_sql()[name]) is None


def test_comparison_sees_differences(spark, con):
    ours = spark.sql("SELECT 1 AS a, 2.5D AS b")
    assert duck.differences(ours, con, "SELECT 1 AS a, 2.5 AS b") is None
    assert "columns" in duck.differences(ours, con, "SELECT 1 AS a, 2.5 AS c")
    assert "rows differ" in duck.differences(ours, con, "SELECT 1 AS a, 2.6 AS b")
    assert "rows differ" in duck.differences(ours, con, "SELECT 1 AS a, NULL AS b")
    assert "2 rows" in duck.differences(ours, con, "SELECT 1 AS a, 2.5 AS b UNION ALL SELECT 1, 2.5")


def test_rows_are_compared_by_column_name():
    assert duck.rows(pd.DataFrame({"b": [1], "a": [2]})) == [(2, 1)]
