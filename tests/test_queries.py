"""Every registered query with SQL gives DuckDB's rows; the others run and have rows."""

import importlib.util

import pytest

from kitloom.plans import registry

from .oracle import DATA, connect, rows_of_spark, rows_of_sql

SF = DATA / "sf0.001"
QUERIES, ORACLE = dict(registry.QUERIES), dict(registry.ORACLE)
MAY_BE_EMPTY = {"table_progressions", "list_stem_runs", "ragged_tables", "pages_to_resume", "charmap_shifts", "repeated_pages"}
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, str(SF))
    if name in ORACLE:
        assert rows_of_spark(df) == rows_of_sql(con, ORACLE[name])
    else:
        assert df.count() > 0 or name in MAY_BE_EMPTY


def test_entry_point_survives_without_the_subpackage():
    spec = importlib.util.find_spec("__spark_entry__")
    assert spec is not None
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
