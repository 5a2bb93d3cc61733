"""Runs a query in Spark and its SQL in DuckDB and compares the results."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from scenarios.queries import TABLES


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(_cell, v)) if isinstance(v, list) else v


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    got_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    if got_types != want_types:
        diff = {n: (got_types[n], want_types[n]) for n in got_types if got_types[n] != want_types[n]}
        return f"types (spark, sql): {diff}"
    got = multiset(df.columns, [tuple(r) for r in df.collect()])
    want = multiset(rel.columns, rel.fetchall())
    if got != want:
        extra, lack = got - want, want - got
        return (
            f"{sum(got.values())} rows, expected {sum(want.values())}; "
            f"extra {list(extra)[:3]}, lacking {list(lack)[:3]}"
        )
    return None
