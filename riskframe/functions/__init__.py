"""Column-expression helpers (JVM-side, codegen friendly) and small scalar helpers."""

from riskframe.functions.names import standardize_name, standardize_columns, quote
from riskframe.functions.numeric import (
    flag, non_finite_to_null, numeric_like, rowwise, safe_ratio, to_double_or_null,
)

__all__ = [
    "standardize_name", "standardize_columns", "quote", "flag", "non_finite_to_null",
    "numeric_like", "rowwise", "safe_ratio", "to_double_or_null",
]
