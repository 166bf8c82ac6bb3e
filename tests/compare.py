"""Compare a Spark result with a DuckDB statement on the same Parquet files."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, int):
        return float(value)
    return str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str):
    """(description of the difference or None, rows)."""
    rows = df.collect()
    mine = rows_of(df.columns, rows)
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(rows)
    theirs = rows_of(columns, cursor.fetchall())
    if mine == theirs:
        return None, len(rows)
    extra = list((mine - theirs).items())[:3]
    missing = list((theirs - mine).items())[:3]
    return (
        f"{sum(mine.values())} vs {sum(theirs.values())} rows; only Spark {extra}; "
        f"only SQL {missing}"
    ), len(rows)
