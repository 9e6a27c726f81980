"""Compare a registered query with its SQL counterpart, order-insensitively."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty text if both give the same columns and rows."""
    cursor = connection.execute(sql)
    theirs_columns = [d[0] for d in cursor.description]
    theirs = sorted_rows(theirs_columns, cursor.fetchall())
    ours = sorted_rows(df.columns, df.collect())
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(df.columns)} != {sorted(theirs_columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return ""
