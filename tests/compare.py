"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_with_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    if v is pd.NA or v is pd.NaT:
        return None
    return v


def canonical_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(repr(_norm(r[i])) for i in order) for r in rows]
    out.sort()
    return out


def digest(columns: list[str], rows: list[tuple]) -> str:
    h = hashlib.sha256()
    for r in canonical_rows(columns, rows):
        h.update("\x1f".join(r).encode())
        h.update(b"\x1e")
    return h.hexdigest()


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    result = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
    }
    result["values_match"] = result["columns_match"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    if result["columns_match"] and not result["values_match"]:
        a = canonical_rows(s_cols, s_rows)
        b = canonical_rows(d_cols, d_rows)
        only_a = [r for r in a if r not in set(b)][:2]
        only_b = [r for r in b if r not in set(a)][:2]
        result["example_spark_only"] = only_a
        result["example_oracle_only"] = only_b
        result["sorted_columns"] = sorted(s_cols)
    if not result["columns_match"]:
        result["spark_only_cols"] = sorted(set(s_cols) - set(d_cols))
        result["oracle_only_cols"] = sorted(set(d_cols) - set(s_cols))
    result["ok"] = result["values_match"] and result["rows_spark"] == result["rows_oracle"]
    return result
