import compare
import pytest

from shardloom.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_duckdb(spark, name):
    con = compare.connect(FOLDER)
    df = QUERIES[name](spark, FOLDER)
    assert compare.type_differences(df, con, SQL[name]) == []
    assert compare.spark_rows(df) == compare.duck_rows(con, SQL[name])
