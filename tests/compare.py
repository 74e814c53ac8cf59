"""Compare a query with its oracle, rows in any order."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    return round(float(value), 6) if isinstance(value, float) else value


def rows_of(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in records), key=repr)


def compare(frame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list, list, list, list]:
    """Sorted column names and rows of both sides."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    expected = rows_of(names, theirs.fetchall())
    actual = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    return sorted(frame.columns), sorted(names), actual, expected
