"""Compare a Spark answer with its SQL, value by value."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(r[i]) for i in order]) for r in rows)


def differences(df, db, sql: str) -> str | None:
    """None if both give the same rows under the same column names."""
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = _rows(df.columns, df.collect()), _rows(names, expected)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"\n  spark {a}\n  sql   {b}"
    return None
