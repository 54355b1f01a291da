"""Order-insensitive compare of a Spark result with a DuckDB oracle result."""

import datetime
import hashlib
import math

import pandas as pd


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if v is pd.NA or v is pd.NaT:
        return "NULL"
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() and abs(v) < 2 ** 53 else repr(round(v, 9))
    if isinstance(v, (pd.Timestamp, datetime.datetime)):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    return str(v)


def digest(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in df.to_dict("records"))
    return hashlib.md5("\n".join(rows).encode()).hexdigest(), rows


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame):
    """(ok, reason)."""
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        return False, f"columns {sorted(spark_pdf.columns)} vs {sorted(oracle_pdf.columns)}"
    if len(spark_pdf) != len(oracle_pdf):
        return False, f"rows {len(spark_pdf)} vs {len(oracle_pdf)}"
    hs, rs = digest(spark_pdf)
    ho, ro = digest(oracle_pdf)
    if hs != ho:
        a, b = set(rs), set(ro)
        return False, f"values: spark-only {list(a - b)[:2]} oracle-only {list(b - a)[:2]}"
    return True, ""
