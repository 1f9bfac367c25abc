"""Compare a Spark result with a DuckDB oracle result, order-insensitively."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return str(v)[:10] if len(str(v)) >= 10 and str(v)[4] == "-" else str(v)
    if isinstance(v, (int,)):
        return float(v)
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def _close(a, b) -> bool:
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    o = con.execute(sql).fetchdf()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"row count {len(s)} vs {len(o)}"
    s = s.astype(object).where(pd.notna(s), None)
    o = o.astype(object).where(pd.notna(o), None)
    rs, ro = _rows(s), _rows(o)
    for a, b in zip(rs, ro):
        if not all(_close(x, y) for x, y in zip(a, b)):
            return False, f"first differing row:\n spark={a}\n duck ={b}\n cols={sorted(s.columns)}"
    return True, f"{len(s)} rows"
