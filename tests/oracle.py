"""Compare a Spark result with SQL run by DuckDB on the same parquet files."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return db


def compare(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if columns, types and rows agree, otherwise what differs."""
    expected = db.execute(sql).to_arrow_table()
    actual = df.toArrow()
    names = sorted(actual.column_names)
    if names != sorted(expected.column_names):
        return f"columns {names} != {sorted(expected.column_names)}"
    types = [(n, actual.schema.field(n).type, expected.schema.field(n).type) for n in names]
    if wrong := [t for t in types if str(t[1]) != str(t[2])]:
        return f"types {wrong}"

    def rows(table) -> list[tuple]:
        columns = [table.column(n).to_pylist() for n in names]
        return sorted(zip(*columns), key=repr)

    ours, theirs = rows(actual), rows(expected)
    if ours != theirs:
        missing = sorted(set(theirs) - set(ours), key=repr)[:3]
        extra = sorted(set(ours) - set(theirs), key=repr)[:3]
        return f"rows {len(ours)} != {len(theirs)}; missing {missing}; extra {extra}"
    return None if ours else "no rows"
