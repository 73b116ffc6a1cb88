"""Rows of a Spark frame and of a DuckDB query, brought to the same form."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), _bag(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, text):
    result = con.execute(text)
    names = [d[0] for d in result.description]
    return sorted(names), _bag(names, result.fetchall())
