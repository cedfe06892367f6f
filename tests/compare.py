"""Compare a query with its SQL on DuckDB, ignoring row order."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(frame, sql: str, connection) -> str | None:
    """None if equal, else a short account of what differs."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    actual = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    if actual == expected:
        return None if expected else "both results are empty"
    only_actual = [row for row in actual if row not in set(expected)][:3]
    only_expected = [row for row in expected if row not in set(actual)][:3]
    return f"{len(actual)} rows != {len(expected)}; {only_actual} / {only_expected}"
