"""Runs a query and its SQL twin side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, sql: str, connection) -> None:
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    want = rows_of(names, expected.fetchall())
    got = rows_of(df.columns, df.collect())
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    assert len(got) == len(want), (len(got), len(want))
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, (len(different), sorted(names), different[:2])
