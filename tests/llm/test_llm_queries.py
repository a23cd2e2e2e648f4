"""Queries with SQL give DuckDB's rows; the others run over their whole tables."""

import pytest

from kitloom.llm import queries

from ..oracle import DATA, connect, rows_of_spark, rows_of_sql

SF = DATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test data")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, str(SF))
    if name in queries.ORACLE:
        assert rows_of_spark(df) == rows_of_sql(connect(SF), queries.ORACLE[name])
    else:
        assert df.count() > 0
