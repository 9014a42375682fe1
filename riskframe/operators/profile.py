"""Profiling: missing values, class balance, describe, distinct counts,
variance, binary checks, class histograms (D4, D5, D9-D14, D19, H8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.names import quote
from riskframe.operators.longform import to_long
from riskframe.operators.ordered import quantile_name
from riskframe.operators.quantiles import column_stats


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, missing_count, missing_rate) from one aggregate."""
    cols = list(df.columns if cols is None else cols)
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.sum(F.col(quote(c)).isNull().cast("long")).alias(f"_m{i}")
                   for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing_count"))
                      for i, c in enumerate(cols)])
    return one.select("_rows", F.inline(pairs)).select(
        "column", F.coalesce("missing_count", F.lit(0)).cast("long").alias("missing_count"),
        F.try_divide(F.coalesce("missing_count", F.lit(0)).cast("double"),
                     F.col("_rows")).alias("missing_rate"))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """(value, count) -- D4."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """One row: rows, class counts, default rate, imbalance ratio.
    Rate and ratio are NULL unless both classes occur."""
    y = F.col(quote(target))
    g = df.agg(F.count(y).alias("n_rows"),
               F.sum((y == 0).cast("long")).alias("n_target_0"),
               F.sum((y == 1).cast("long")).alias("n_target_1"),
               F.avg(y.cast("double")).alias("_mean"))
    both = (F.col("n_target_0") > 0) & (F.col("n_target_1") > 0)
    return g.select(
        "n_rows", "n_target_0", "n_target_1",
        F.when(both, F.col("_mean")).alias("default_rate"),
        F.when(both, F.greatest("n_target_0", "n_target_1").cast("double")
               / F.least("n_target_0", "n_target_1")).alias("imbalance_ratio"))


def describe_numeric(df: DataFrame, cols: Sequence[str],
                     probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std (ddof=1), min, exact quartiles, max, missing count and
    rate per column (D9); quartiles by bracket selection.  A column without
    values has no row."""
    cols, probs = list(cols), list(probs)
    stats = column_stats(df, cols, probs)
    rows, moments = df.count(), {}
    for s in range(0, len(cols), 32):
        part = cols[s:s + 32]
        found = df.agg(*[e.alias(f"{k}{i}") for i, c in enumerate(part) for k, e in (
            ("m", F.avg(F.col(quote(c)).cast("double"))), ("s", F.stddev_samp(F.col(quote(c)).cast("double"))))]).first()
        moments |= {c: (found[f"m{i}"], found[f"s{i}"]) for i, c in enumerate(part)}
    return df.sparkSession.createDataFrame(
        [(c, s.n, *moments[c], s.low, *s.quantiles, s.high, rows - s.n, (rows - s.n) / max(rows, 1)) for c, s in stats.items() if s.n],
        "feature string, count long, mean double, std double, min double, "
        + "".join(f"{quantile_name(p)} double, " for p in probs) + "max double, missing_count long, missing_rate double")


def distinct_counts(df: DataFrame, cols: Sequence[str], value_type: str = "string") -> DataFrame:
    """Exact distinct values per column, without and with the missing level.
    Long form: one shuffle on (feature, value) with map-side de-duplication."""
    long = to_long(df, cols, value_type=value_type)
    d = long.groupBy("feature", "value").agg(F.lit(1).alias("_x"))
    return d.groupBy("feature").agg(
        F.count("value").alias("n_distinct"),
        (F.count("value") + F.max(F.col("value").isNull().cast("int"))).alias("n_distinct_with_missing"))


def feature_variance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, variance) with ddof=1."""
    return to_long(df, cols).groupBy("feature").agg(F.var_samp("value").alias("variance"))


def binary_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, is_binary): every non-missing value is 0 or 1 (H8)."""
    return to_long(df, cols).groupBy("feature").agg(
        F.coalesce(F.min(F.when(F.col("value").isNull(), 1)
                         .when(F.col("value").isin(0.0, 1.0), 1).otherwise(0)), F.lit(1))
        .alias("is_binary"))


def class_histogram(df: DataFrame, feature: str, target: str, bins: int = 40,
                    clip: tuple[float, float] = (0.01, 0.99)) -> DataFrame:
    """Density histogram of a clipped feature per class.

    Bounds are the exact 1%/99% quantiles over all rows; each class's bins span
    its own clipped min..max, like a per-class histogram, and empty bins are rows
    with count 0 (a class of one value has a single bin); density =
    count / (class rows * bin width).  Uses every row (no sampling).  The
    target has two classes at most, others raise.
    """
    x = F.col(quote(feature)).cast("double")
    base = df.select(x.alias("x"), F.col(quote(target)).alias("target")).where(
        F.col("x").isNotNull() & F.col("target").isNotNull())
    lo, hi = column_stats(base, ["x"], clip)["x"].quantiles
    if lo is None:
        lo = hi = 0.0
    clipped = base.select("target", F.least(F.greatest("x", F.lit(lo)), F.lit(hi)).alias("x"))
    rng = clipped.groupBy("target").agg(F.min("x").alias("lo"), F.max("x").alias("hi"),
                                        F.count(F.lit(1)).alias("n_class"))
    classes = rng.limit(3).collect()
    if len(classes) > 2:
        raise ValueError(f"{target!r} has more than two classes")
    rng = df.sparkSession.createDataFrame(classes, rng.schema)
    w = (F.col("hi") - F.col("lo")) / F.lit(bins)
    b = F.when(w > 0, F.least(F.floor((F.col("x") - F.col("lo")) / w), F.lit(bins - 1))) \
        .otherwise(F.lit(0)).cast("int")
    counts = (clipped.join(F.broadcast(rng), "target")     # two rows at most
              .select("target", b.alias("bin"))
              .groupBy("target", "bin").agg(F.count(F.lit(1)).alias("count")))
    every = F.when(F.col("hi") > F.col("lo"), F.sequence(F.lit(0), F.lit(bins - 1))).otherwise(F.array(F.lit(0)))
    hist = (rng.withColumn("bin", F.explode(every)).join(counts, ["target", "bin"], "left")
            .withColumn("count", F.coalesce("count", F.lit(0))))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / F.lit(bins)) \
        .otherwise(F.lit(1.0))
    return hist.select(
        "target", "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        "count", (F.col("count") / (F.col("n_class") * width)).alias("density"))
