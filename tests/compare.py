"""Order-insensitive comparison of query results (Spark vs DuckDB)."""

from __future__ import annotations

import decimal
import hashlib

import pandas as pd


def norm(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    out = pd.DataFrame({c: [norm(v) for v in df[c].astype(object)] for c in df.columns})
    if out.empty:
        return out
    return out.sort_values(list(out.columns), na_position="first").reset_index(drop=True)


def digest(df: pd.DataFrame) -> str:
    h = hashlib.sha256()
    for row in df.itertuples(index=False):
        h.update(repr(tuple(row)).encode())
    return h.hexdigest()


def duck_frame(con, sql: str) -> pd.DataFrame:
    res = con.sql(sql).arrow()
    res = res.read_all() if hasattr(res, "read_all") else res
    return res.to_pandas()


def same(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"row counts differ: {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = canon(spark_pdf), canon(duck_pdf)
    if digest(a) != digest(b):
        diff = a.merge(b, how="outer", indicator=True)
        return False, diff[diff["_merge"] != "both"].head(10).to_string()
    return True, ""
