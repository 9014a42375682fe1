"""Encoding, clipping and scaling with fitted state.

Each transformer is ``fit`` on chosen rows (training rows by default in the
modelling plan) and ``transform``s any rows with one static projection.
Fitted state is tiny -- levels, bounds, moments per column -- and can be saved
as a Parquet table and loaded back to score new data.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.names import quote, unique_names
from riskframe.operators.levels import bounded_levels
from riskframe.operators.longform import string_columns, to_long
from riskframe.operators.quantiles import column_stats
from riskframe.spec import CLIP_QUANTILES, LABEL_ENCODE_MAX_LEVELS, ONE_HOT_MAX_LEVELS, TEXT_FILL


@dataclass
class CategoryEncoder:
    """Per text column: <= 2 levels (missing counted as a level) -> label code in
    sorted level order; <= 10 -> one-hot with the first sorted level dropped
    (int8 columns ``COL_LEVEL`` appended at the end); more -> column dropped.
    Missing text is encoded as ``missing_as`` before the decision."""

    label: dict[str, list[str]] = field(default_factory=dict)
    one_hot: dict[str, list[str]] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    missing_as: str = TEXT_FILL

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str] | None = None, exclude: Sequence[str] = (),
            label_max: int = LABEL_ENCODE_MAX_LEVELS, one_hot_max: int = ONE_HOT_MAX_LEVELS,
            missing_as: str = TEXT_FILL) -> "CategoryEncoder":
        cols = string_columns(df, exclude) if cols is None else list(cols)
        enc = cls(missing_as=missing_as)
        if not cols:
            return enc
        found = bounded_levels(df, cols, one_hot_max, missing_as)
        for c in cols:
            lv = found[c]
            if lv is None:
                enc.dropped.append(c)
            elif len(lv) <= label_max:
                enc.label[c] = lv
            else:
                enc.one_hot[c] = lv
        return enc

    def transform(self, df: DataFrame) -> DataFrame:
        out, tail = [], []
        for c in df.columns:
            if c in self.dropped:
                continue
            v = F.coalesce(F.col(quote(c)), F.lit(self.missing_as))
            if c in self.label:
                code = None
                for i, lvl in enumerate(self.label[c]):
                    code = (F.when(v == lvl, F.lit(i)) if code is None
                            else code.when(v == lvl, F.lit(i)))
                out.append((code if code is not None else F.lit(None)).cast("int").alias(c))
            elif c in self.one_hot:
                for lvl in self.one_hot[c][1:]:   # drop the first sorted level
                    tail.append((v == lvl).cast("tinyint").alias(f"{c}_{lvl}"))
            else:
                out.append(F.col(quote(c)))
        found = df.select(*out, *tail)
        # Levels that differ in case only would give columns that Spark cannot tell apart.
        return found.toDF(*unique_names(found.columns))

    def to_json(self) -> str:
        return json.dumps({"label": self.label, "one_hot": self.one_hot,
                           "dropped": self.dropped, "missing_as": self.missing_as})


@dataclass
class Winsorizer:
    """Clip each numeric column to its exact linear-interpolated [1%, 99%]
    quantiles (B16).  With ``skip_binary`` (the feature step) a column with <= 2
    distinct non-missing values is left alone, and a column is clipped only
    when lo < hi; without it (the sample step) every column is clipped."""

    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], probs: tuple[float, float] = CLIP_QUANTILES,
            skip_binary: bool = True) -> "Winsorizer":
        cols = list(cols)
        if not cols:
            return cls()
        bounds = {}
        for c, found in column_stats(df, cols, probs).items():
            lo, hi = found.quantiles
            if lo is None or (skip_binary and not (found.more_than_two and lo < hi)):
                continue
            bounds[c] = (float(lo), float(hi))
        return cls(bounds)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[
            F.when(F.col(quote(c)).isNotNull(),
                   F.least(F.greatest(F.col(quote(c)), F.lit(self.bounds[c][0])),
                           F.lit(self.bounds[c][1]))).alias(c)
            if c in self.bounds else F.col(quote(c))
            for c in df.columns])


@dataclass
class StandardScaler:
    """(x - mean) / std with ddof=0 over non-missing values; a zero std divides
    by 1; columns whose values are all in {0, 1} are not scaled (J4)."""

    moments: dict[str, tuple[float, float]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], skip_binary: bool = True) -> "StandardScaler":
        cols = list(cols)
        if not cols:
            return cls()
        g = to_long(df, cols).groupBy("feature").agg(
            F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
            F.min(F.when(F.col("value").isNull() | F.col("value").isin(0.0, 1.0), 1)
                  .otherwise(0)).alias("binary"))
        moments = {}
        for r in g.collect():
            if skip_binary and r["binary"] == 1:
                continue
            mean = r["mean"] if r["mean"] is not None else 0.0
            std = r["std"] if r["std"] not in (None, 0.0) else 1.0
            moments[r["feature"]] = (float(mean), float(std))
        return cls(moments)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[
            ((F.col(quote(c)) - F.lit(self.moments[c][0])) / F.lit(self.moments[c][1])).alias(c)
            if c in self.moments else F.col(quote(c)) for c in df.columns])

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """Fitted state as a table (A5): (column, mean, std)."""
        rows = [(c, m, s) for c, (m, s) in sorted(self.moments.items())]
        return spark.createDataFrame(rows, "column string, mean double, std double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "StandardScaler":
        return cls({r["column"]: (r["mean"], r["std"]) for r in spark.read.parquet(path).collect()})
