"""Run a registered query on Spark and its SQL twin on DuckDB, and compare them row by row."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    return int(value) if hasattr(value, "__int__") else value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None
    missing, extra = want - got, got - want
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; missing {sum(missing.values())}"
        f" e.g. {list(missing)[:2]}; extra {sum(extra.values())} e.g. {list(extra)[:2]}"
    )
