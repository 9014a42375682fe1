"""Numeric column expressions: guarded casts, ratios, flags, row-wise statistics.

NULL is the only missing marker inside riskframe: NaN and +-Inf are turned into
NULL at ingest (:func:`non_finite_to_null`), because Spark aggregates skip NULL
but not NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepts what a plain decimal/scientific parser accepts; rejects Spark-only
# forms such as '1d' or '2f' and the words nan/inf.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_finite_to_null(c) -> Column:
    """NaN, +Inf and -Inf become NULL."""
    c = _col(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def numeric_like(c) -> Column:
    """True when the trimmed text parses as a finite decimal number."""
    return F.trim(_col(c)).rlike(_NUMBER)


def text_to_double(c) -> Column:
    """Trimmed text -> double when it looks like a decimal number, else NULL."""
    c = F.trim(_col(c))
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def to_double_or_null(c, text: bool = False) -> Column:
    """Forced numeric conversion, unparseable or non-finite -> NULL."""
    return non_finite_to_null(text_to_double(c) if text else _col(c))


def safe_ratio(num, den) -> Column:
    """num / den with a zero denominator and +-Inf results as NULL."""
    num, den = _col(num).cast("double"), _col(den).cast("double")
    return non_finite_to_null(F.try_divide(num, F.nullif(den, F.lit(0.0))))


def flag(cond: Column) -> Column:
    """Comparison -> 0/1 int where a missing operand counts as false (H4)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def rowwise(cols: list[str]) -> dict[str, Column]:
    """Row-wise statistics across columns, skipping NULL like pandas (H5).

    mean/min/max are NULL when every value is missing; std uses ddof=1 and is
    0 below two values; prod of nothing is 1; sum of nothing is 0.
    """
    cs = [F.col(c) for c in cols]
    present = sum((c.isNotNull().cast("int") for c in cs), F.lit(0))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs), F.lit(0.0))
    mean = F.when(present > 0, total / present)
    sq = sum((F.when(c.isNotNull(), (c - mean) * (c - mean)).otherwise(F.lit(0.0)) for c in cs),
             F.lit(0.0))
    std = F.when(present >= 2, F.sqrt(sq / (present - 1))).otherwise(F.lit(0.0))
    prod = F.lit(1.0)
    for c in cs:
        prod = prod * F.coalesce(c, F.lit(1.0))
    return {
        "mean": mean,
        "min": F.least(*cs) if len(cs) > 1 else cs[0],
        "max": F.greatest(*cs) if len(cs) > 1 else cs[0],
        "std": std,
        "prod": prod,
        "sum": total,
        "count": present,
    }
