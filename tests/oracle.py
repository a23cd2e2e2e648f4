"""Compares a registered query with its SQL on DuckDB, as sorted rows of text."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb

DATA = Path(os.environ.get("KITLOOM_TESTDATA", "/root/testdata"))


def connect(sf_dir: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(sf_dir.glob("*.parquet")):
        source = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{source}')")
    return con


def _text(value: object) -> str:
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(_text, value)) + "]"
    return str(value)


def rows_of_sql(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple[str, ...]]]:
    cursor = con.execute(sql)
    names = [x[0] for x in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(_text(row[i]) for i in order) for row in cursor.fetchall())


def rows_of_spark(df) -> tuple[list[str], list[tuple[str, ...]]]:
    names = sorted(df.columns)
    return names, sorted(tuple(_text(row[n]) for n in names) for row in df.collect())
