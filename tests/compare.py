"""Compare a Spark result with DuckDB's over the same parquet tables."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    link = duckdb.connect()
    for name in TABLES:
        link.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return link


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else format(value, ".12g")
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted(tuple(plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], body


def kinds(columns, rows):
    """Python types per column, to catch a bigint against a double."""
    seen = {}
    for i, name in enumerate(columns):
        seen[name] = {type(row[i]).__name__ for row in rows if row[i] is not None}
    return seen


def spark_rows(df):
    return df.columns, [tuple(row) for row in df.collect()]


def oracle_rows(link, text):
    cursor = link.execute(text)
    return [d[0] for d in cursor.description], cursor.fetchall()


def difference(df, link, text):
    """None when equal, else a short description."""
    left_columns, left_rows = spark_rows(df)
    right_columns, right_rows = oracle_rows(link, text)
    left_names, left = canonical(left_columns, left_rows)
    right_names, right = canonical(right_columns, right_rows)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(pairs)} rows differ, first {pairs[0]}"
    if kinds(left_columns, left_rows) != kinds(right_columns, right_rows):
        return f"types {kinds(left_columns, left_rows)} != {kinds(right_columns, right_rows)}"
    return None
