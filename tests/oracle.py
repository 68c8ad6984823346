"""Runs a query in Spark and its SQL in DuckDB over the same tables and tells how they differ."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


def plain(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    norm = lambda v: None if v is None or (not isinstance(v, (list, dict, str)) and pd.isna(v)) else round(float(v), 9) if isinstance(v, float) else v.item() if hasattr(v, "item") else v
    return sorted((tuple(norm(v) for v in row) for row in df[cols].itertuples(index=False)), key=repr)


def difference(spark, c, query, sql: str, sf_dir: str) -> str:
    """Empty if both give the same columns and rows."""
    a, b = query(spark, sf_dir).toPandas(), c.execute(sql).df()
    if sorted(a.columns) != sorted(b.columns):
        return f"columns {sorted(a.columns)} and {sorted(b.columns)}"
    x, y = plain(a), plain(b)
    if len(x) != len(y):
        return f"{len(x)} and {len(y)} rows; first only here {[r for r in x if r not in set(map(repr, y))][:1] if len(x) < 2000 else ''}"
    for p, q in zip(x, y, strict=True):
        if p != q and repr(p) != repr(q):
            return f"columns {sorted(a.columns)}: {p} and {q}"
    return ""
