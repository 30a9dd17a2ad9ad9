"""Run a registered query and its DuckDB oracle side by side and compare
(row count, column names, order-insensitive values)."""

from __future__ import annotations

import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    return v


def _rows(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, name: str, sf_dir: str, queries: dict, sql: dict, con=None) -> dict:
    con = con or duckdb_conn(sf_dir)
    sdf = queries[name](spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [r.asDict() for r in sdf.collect()]
    rel = con.sql(sql[name])
    d_cols = sorted(rel.columns)
    d_rows = [dict(zip(rel.columns, t)) for t in rel.fetchall()]
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols}
    if res["columns_match"]:
        a, b = _rows(s_rows, s_cols), _rows(d_rows, d_cols)
        res["values_match"] = a == b
        if a != b:
            diff = [x for x in a if x not in set(b)][:3]
            res["example_spark_only"] = diff
            res["example_oracle_only"] = [x for x in b if x not in set(a)][:3]
    else:
        res["spark_columns"], res["oracle_columns"] = s_cols, d_cols
        res["values_match"] = False
    return res
