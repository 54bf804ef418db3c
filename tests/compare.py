"""Compare a Spark result with DuckDB's answer to the oracle SQL, value by value."""

from __future__ import annotations

import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, list):
        return tuple(_norm(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    t1 = time.time()
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    t2 = time.time()
    only_spark = [r for r in got if r not in set(want)][:3] if got != want else []
    only_sql = [r for r in want if r not in set(got)][:3] if got != want else []
    return {
        "columns": sorted(df.columns) == sorted(cols),
        "rows": (len(got), len(want)),
        "equal": got == want and sorted(df.columns) == sorted(cols),
        "only_spark": only_spark,
        "only_sql": only_sql,
        "spark_s": round(t1 - t0, 2),
        "sql_s": round(t2 - t1, 2),
        "cols": (sorted(df.columns), sorted(cols)),
    }
