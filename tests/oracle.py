"""Comparing a Spark result with DuckDB: same columns, same rows in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def normalised(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def from_duckdb(connection, sql: str) -> tuple[list[str], list[str], list[tuple[str, ...]]]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    return columns, types, normalised(columns, result.fetchall())


def from_spark(df) -> tuple[list[str], list[str], list[tuple[str, ...]]]:
    return df.columns, [t for _, t in df.dtypes], normalised(df.columns, [tuple(r) for r in df.collect()])
