"""Run a query key in Spark and its oracle SQL in DuckDB; compare the results.

The comparison mirrors the driver's: row count, column names, and an
order-insensitive hash of the values with columns sorted by name.
"""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def canon(columns: list[str], rows: list[tuple]) -> tuple[list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    digest = hashlib.sha256("\n".join(keyed).encode()).hexdigest()
    return [columns[i] for i in order], digest


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, [tuple(r) for r in cur.fetchall()]


def compare(spark, con, key: str, sf_dir: str, queries: dict, oracle: dict) -> dict:
    df = queries[key](spark, sf_dir)
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, oracle[key])
    sc, sh = canon(s_cols, s_rows)
    dc, dh = canon(d_cols, d_rows)
    return {"key": key, "rows": (len(s_rows), len(d_rows)), "cols_match": sc == dc,
            "hash_match": sh == dh, "spark_cols": sc, "duck_cols": dc,
            "spark_types": [f.dataType.simpleString() for f in df.schema.fields]}


def first_diff(spark_rows_, duck_rows_, n=5):
    """Rows present on one side only (for debugging)."""
    s = {repr(tuple(_norm(v) for v in r)) for r in spark_rows_}
    d = {repr(tuple(_norm(v) for v in r)) for r in duck_rows_}
    return sorted(s - d)[:n], sorted(d - s)[:n]
