"""Compare a Spark result with DuckDB's, as multisets of rows."""

from __future__ import annotations

from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _type(name: str) -> str:
    name = name.lower()
    return {"varchar": "string", "integer": "int"}.get(name, name)


def spark_rows(frame):
    types = dict(frame.dtypes)
    names = sorted(types)
    rows = Counter(tuple(row[n] for n in names) for row in frame.collect())
    return names, [_type(types[n]) for n in names], rows


def duck_rows(connection, sql: str):
    result = connection.execute(sql)
    types = {d[0]: _type(str(d[1])) for d in result.description}
    order = [d[0] for d in result.description]
    names = sorted(types)
    at = [order.index(n) for n in names]
    rows = Counter(tuple(row[i] for i in at) for row in result.fetchall())
    return names, [types[n] for n in names], rows


def plain(rows: Counter) -> Counter:
    """Drop time zones that collecting may attach."""
    def value(v):
        return v.replace(tzinfo=None) if isinstance(v, datetime) else v

    return Counter({tuple(value(v) for v in row): n for row, n in rows.items()})
