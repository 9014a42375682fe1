"""Wide <-> long helpers.

Per-column statistics over hundreds of columns are computed in long form
``(feature, value)``: one ``groupBy(feature)`` whose partial aggregation runs
map-side, instead of hundreds of aggregate expressions that push a stage past
the whole-stage-codegen field limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from riskframe.functions.names import quote


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of a numeric type (booleans are not numeric), minus ``exclude``."""
    skip = {c.upper() for c in exclude}
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)
            and f.name.upper() not in skip]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skip = {c.upper() for c in exclude}
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name.upper() not in skip]


def to_long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
            value_type: str = "double", feature: str = "feature",
            value: str = "value") -> DataFrame:
    """Unpivot ``cols`` into ``(keep..., feature, value)``; NULL values are kept."""
    cols = list(cols)
    if not cols:
        raise ValueError("no columns to unpivot")
    pairs = F.array(*[F.struct(F.lit(c).alias("f"), F.col(quote(c)).cast(value_type).alias("v"))
                      for c in cols])
    return (df.select(*[F.col(quote(k)) for k in keep], F.inline(pairs))
            .withColumnRenamed("f", feature).withColumnRenamed("v", value))
