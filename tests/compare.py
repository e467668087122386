"""Compare a Spark result with DuckDB SQL over the same parquet tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, int):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def differences(df, con, sql: str) -> str | None:
    """None if both sides agree, else what differs first."""
    got_columns = df.columns
    got = _rows(got_columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = _rows(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {got_columns} <> {want_columns}"
    if len(got) != len(want):
        extra = sorted(set(map(repr, got)) ^ set(map(repr, want)))[:6]
        return f"rows {len(got)} <> {len(want)}; {extra}"
    for a, b in zip(got, want):
        if a != b:
            return f"row {a} <> {b}"
    return None
