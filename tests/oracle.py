"""Run a registered query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_cell(r[i]) for i in order] for r in rows), key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


def compare(spark, con, sf_dir, query, sql) -> str | None:
    """None when both agree exactly, else the first difference."""
    df = query(spark, sf_dir)
    got = df.collect()
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    kinds = {type(v) for r in a for v in r}, {type(v) for r in b for v in r}
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{sorted(df.columns)}\n  spark {x}\n  sql   {y} kinds {kinds}"
    return None
