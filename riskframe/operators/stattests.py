"""Two-sample tests against a 0/1 target.

Statistics are exact aggregates over per-value class counts; the tail
probabilities are column expressions on the one row per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.distributions import chi2_p, normal_p
from riskframe.functions.names import quote
from riskframe.operators.longform import to_long
from riskframe.operators.ordered import cumulative_before, moments_from_counts, value_counts
from riskframe.spec import MIN_ROWS_PER_CLASS, TEXT_FILL


def mann_whitney_stats(df: DataFrame, features: Sequence[str], target: str,
                       min_rows: int = MIN_ROWS_PER_CLASS) -> DataFrame:
    """Two-sided Mann-Whitney U of class 0 vs class 1 per feature, tie-corrected
    normal approximation with continuity correction, plus group means and
    Cohen's d = (mean1 - mean0) / sqrt((var0 + var1) / 2) (0 when that is 0).

    Features with fewer than ``min_rows`` values in either class are skipped.
    Columns: feature, n0, n1, u_stat (class-0 U), z, group0_mean, group1_mean, cohens_d.
    """
    long = to_long(df, features, keep=[target]).where(
        F.col("value").isNotNull() & F.col(quote(target)).isin(0, 1))
    y = F.col(quote(target))
    vc = value_counts(long, ["feature"], "value", {"n": F.lit(1), "n0": (y == 0).cast("int")})
    oc = cumulative_before(vc, ["feature"], ["value"], ["n", "n0"], groups_hint=len(features))
    rank = F.col("n_before") + (F.col("n") + 1) / 2.0
    ranks = oc.groupBy("feature").agg(
        F.sum(F.col("n0") * rank).alias("_r0"),
        F.sum(F.col("n").cast("double") ** 3 - F.col("n")).alias("_ties"))
    # class moments from the same per-value counts: no second pass over the rows
    mom = moments_from_counts(vc, ["feature"], "value",
                              {"c0": F.col("n0"), "c1": F.col("n") - F.col("n0")},
                              groups_hint=len(features))
    moments = mom.select("feature", F.col("c0_count").alias("n0"), F.col("c1_count").alias("n1"),
                         F.col("c0_mean").alias("group0_mean"), F.col("c1_mean").alias("group1_mean"),
                         F.col("c0_var").alias("_v0"), F.col("c1_var").alias("_v1"))
    g = moments.join(ranks, "feature").where(
        (F.col("n0") >= min_rows) & (F.col("n1") >= min_rows))
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    nn = n0 + n1
    u0 = F.col("_r0") - n0 * (n0 + 1) / 2.0
    u = F.greatest(u0, n0 * n1 - u0)
    s = F.sqrt(n0 * n1 / 12.0 * ((nn + 1) - F.col("_ties") / (nn * (nn - 1))))
    z = F.when(s > 0, (u - n0 * n1 / 2.0 - 0.5) / s)
    pooled = F.sqrt((F.col("_v0") + F.col("_v1")) / 2.0)
    d = F.when(pooled > 0, (F.col("group1_mean") - F.col("group0_mean")) / pooled).otherwise(0.0)
    return g.select("feature", F.col("n0").cast("long").alias("n0"),
                    F.col("n1").cast("long").alias("n1"), u0.alias("u_stat"), z.alias("z"),
                    "group0_mean", "group1_mean", d.alias("cohens_d"))


def mann_whitney(df: DataFrame, features: Sequence[str], target: str,
                 min_rows: int = MIN_ROWS_PER_CLASS) -> DataFrame:
    """:func:`mann_whitney_stats` plus ``p_value`` (= erfc(z / sqrt 2), clipped to
    1; underflows to 0.0 like the reference's published rows), ordered by p."""
    st = mann_whitney_stats(df, features, target, min_rows)
    return st.withColumn("p_value", normal_p(F.col("z"))).orderBy("p_value", "feature")


def chi_square_stats(df: DataFrame, categoricals: Sequence[str], target: str,
                     correction: bool = True, missing_level: str = TEXT_FILL) -> DataFrame:
    """Chi-square test of independence of each category column with the target,
    with Cramér's V = sqrt(chi2 / (N * min(r-1, c-1))) and no bias correction.
    Yates' correction (|o - e| reduced by min(0.5, |o - e|)) applies when dof = 1.
    Missing values form their own level.  Columns: feature, n_levels, dof, chi2,
    cramers_v."""
    long = to_long(df, categoricals, keep=[target], value_type="string").where(
        F.col(quote(target)).isin(0, 1))
    y = F.col(quote(target))
    cells = long.select("feature", F.coalesce("value", F.lit(missing_level)).alias("level"),
                        y.alias("y")) \
        .groupBy("feature", "level").agg(F.count(F.when(F.col("y") == 0, 1)).alias("o0"),
                                         F.count(F.when(F.col("y") == 1, 1)).alias("o1"))
    w = Window.partitionBy("feature")   # levels of one feature: a small group
    cells = cells.select("*", F.sum("o0").over(w).alias("c0"), F.sum("o1").over(w).alias("c1"),
                         F.count(F.lit(1)).over(w).alias("n_levels"))
    nn = F.col("c0") + F.col("c1")
    row = F.col("o0") + F.col("o1")
    e0, e1 = row * F.col("c0") / nn, row * F.col("c1") / nn
    dof = (F.col("n_levels") - 1)
    def term(o, e):
        diff = F.abs(F.col(o) - e)
        adj = F.when(F.lit(correction) & (dof == 1), F.least(F.lit(0.5), diff)).otherwise(0.0)
        return F.when(e > 0, (diff - adj) * (diff - adj) / e).otherwise(0.0)
    per = cells.select("feature", "n_levels", "c0", "c1", (term("o0", e0) + term("o1", e1)).alias("t"))
    g = per.groupBy("feature").agg(F.first("n_levels").alias("n_levels"),
                                   F.first("c0").alias("c0"), F.first("c1").alias("c1"),
                                   F.sum("t").alias("chi2"))
    valid = (F.col("c0") > 0) & (F.col("c1") > 0) & (F.col("n_levels") > 1)
    n = F.col("c0") + F.col("c1")
    return g.select("feature", F.col("n_levels").cast("long").alias("n_levels"),
                    (F.col("n_levels") - 1).cast("long").alias("dof"),
                    F.when(valid, F.col("chi2")).alias("chi2"),
                    F.when(valid, F.sqrt(F.col("chi2") / n)).alias("cramers_v"))


def chi_square(df: DataFrame, categoricals: Sequence[str], target: str,
               correction: bool = True, missing_level: str = TEXT_FILL) -> DataFrame:
    """:func:`chi_square_stats` plus ``p_value``, ordered by p."""
    st = chi_square_stats(df, categoricals, target, correction, missing_level)
    return st.withColumn("p_value", chi2_p(F.col("chi2"), F.col("dof").cast("double"))) \
        .orderBy("p_value", "feature")
