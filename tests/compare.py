"""Compare a Spark result with the same query in DuckDB, as multisets of rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short description."""
    cursor = con.execute(sql)
    want_names, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    got_names, got = _rows(df.columns, df.collect())
    if want_names != got_names:
        return f"columns {got_names} instead of {want_names}"
    if want != got:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"{sum(extra.values())} extra e.g. {list(extra)[:2]}; missing e.g. {list(missing)[:2]}"
        )
    return None
