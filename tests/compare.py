"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def oracle_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    return sorted(names), rows


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = Counter(tuple(plain(row[name]) for name in names) for row in df.collect())
    return names, rows
