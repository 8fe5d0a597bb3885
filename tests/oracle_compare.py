"""Run a registered query on Spark and its SQL twin on DuckDB; compare.

Mirrors the driver's gate: same column names, same row count, same multiset
of rows (order-insensitive), with dates/timestamps/decimals normalised.
"""

from __future__ import annotations

import datetime as _dt
import decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def compare(spark, con, name, spark_fn, sql, sf_dir):
    sdf = spark_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=repr)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = sorted((tuple(_norm(x) for x in r) for r in rel.fetchall()), key=repr)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} duckdb={d_cols}")
    else:
        idx = [d_cols.index(c) for c in s_cols]
        d_rows = sorted((tuple(r[i] for i in idx) for r in d_rows), key=repr)
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duckdb={len(d_rows)}")
    if not problems and s_rows != d_rows:
        only_s = [r for r in s_rows if r not in set(d_rows)][:3]
        only_d = [r for r in d_rows if r not in set(s_rows)][:3]
        problems.append(f"values differ; spark-only {only_s}; duckdb-only {only_d}")
    return len(s_rows), problems
