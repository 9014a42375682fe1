"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "is_finite"):  # Decimal
        return round(float(v), 9)
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in t))


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    srows, scols = spark_df.collect(), spark_df.columns
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    if sorted(scols) != sorted(dcols):
        return f"columns differ: {sorted(scols)} vs {sorted(dcols)}"
    a, b = canonical(scols, srows), canonical(dcols, drows)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"row differs: {x} vs {y}"
    return None
