"""Every registered query against DuckDB on the same tables."""

import os

import compare
import pytest

import __spark_entry__ as contract
from shardloom.workloads import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WITHOUT_SQL = {"fit_classifier"}


@pytest.fixture(scope="module")
def duck():
    con = compare.connect(FOLDER)
    yield con
    con.close()


def test_only_the_known_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_equals_duckdb(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql()[name]
    assert compare.type_differences(df, duck, sql) == []
    found, expected = compare.spark_rows(df), compare.duck_rows(duck, sql)
    assert found[0] == expected[0]
    assert found[1] == expected[1]


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_runs(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["subject_id", "split", "n_rows"]
    assert df.count() > 0
