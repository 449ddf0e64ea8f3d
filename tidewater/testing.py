"""Order-insensitive comparison of Spark results with DuckDB results."""

from __future__ import annotations

import datetime as dt
import decimal
import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if hasattr(v, "isoformat"):
        if isinstance(v, dt.datetime):
            return v.replace(tzinfo=None).isoformat(sep=" ")
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql):
    """Return None when equal, else a short description of the difference."""
    cols = spark_df.columns
    srows = rows_of(cols, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    dcols = [c[0] for c in cur.description]
    drows = rows_of(dcols, cur.fetchall())
    if sorted(cols) != sorted(dcols):
        return f"columns spark={sorted(cols)} duck={sorted(dcols)}"
    if srows != drows:
        return f"values differ: spark {len(srows)} rows, duck {len(drows)} rows"
    return None
