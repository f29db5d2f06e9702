"""Comparing a Spark result with DuckDB's on the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        return float(value) if value % 1 else int(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(frame, connection, query: str) -> int:
    names, ours = _bag(frame.columns, frame.collect())
    result = connection.execute(query)
    oracle_names, theirs = _bag([c[0] for c in result.description], result.fetchall())
    assert names == oracle_names, (names, oracle_names)
    only_ours, only_theirs = ours - theirs, theirs - ours
    assert not only_ours and not only_theirs, (
        f"{sum(only_ours.values())} rows only in Spark, {sum(only_theirs.values())} only in SQL; "
        f"e.g. {list(only_ours)[:2]} / {list(only_theirs)[:2]} ({names})"
    )
    return sum(ours.values())
