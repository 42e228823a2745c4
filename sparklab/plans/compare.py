"""Compare a Spark result with a DuckDB result the way the correctness gate
does: same column names (sorted), same row count, and an order-insensitive
multiset of rows with floats rounded to a relative tolerance."""

from __future__ import annotations

import math

import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == 0:
            return 0.0
        return float(f"{v:.{digits}g}")
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def rows_of(pdf: pd.DataFrame, digits: int = 9):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v.item() if hasattr(v, "item") and not isinstance(v, (list, tuple)) else v, digits)
                         for v in rec))
    return cols, sorted(out, key=repr)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, digits: int = 9) -> str | None:
    """None when equal, else a short description of the first difference."""
    sc, sr = rows_of(spark_pdf, digits)
    dc, dr = rows_of(duck_pdf, digits)
    if sc != dc:
        return f"columns differ: spark={sc} duckdb={dc}"
    if len(sr) != len(dr):
        return f"row count differs: spark={len(sr)} duckdb={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return f"first differing row: spark={a} duckdb={b}"
    return None
