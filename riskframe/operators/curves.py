"""Score-vs-label evaluation: ROC and PR points, ROC-AUC, average precision,
confusion metrics (E2, E3, K8-K10).

All of them come from per-distinct-score class counts and the exact
cumulative counts of :mod:`riskframe.operators.ordered`; several models are
evaluated in one pass by putting their scores in long form ``(model, score, y)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.names import quote
from riskframe.operators.longform import to_long
from riskframe.operators.ordered import ordered_value_counts


def scores_long(df: DataFrame, score_cols: Sequence[str], label: str) -> DataFrame:
    """(model, score, y) from one column per model."""
    return (to_long(df, score_cols, keep=[label], feature="model", value="score")
            .select("model", "score", F.col(quote(label)).cast("int").alias("y")))


def threshold_counts(long: DataFrame, groups_hint: int | None = None) -> DataFrame:
    """Per (model, distinct score): n0, n1 at the score, and tp/fp for the rule
    ``score >= threshold`` (descending thresholds), plus class totals P and N.
    -0.0 and 0.0 are one value (grouping normalises them)."""
    y = F.col("y")
    oc = ordered_value_counts(long.where(y.isin(0, 1)), ["model"], "score",
                              {"n0": (y == 0).cast("int"), "n1": (y == 1).cast("int")},
                              groups_hint=groups_hint)
    return oc.select(
        "model", F.col("score").alias("threshold"), "n0", "n1",
        (F.col("n1_total") - F.col("n1_before")).alias("tp"),
        (F.col("n0_total") - F.col("n0_before")).alias("fp"),
        "n0_before", F.col("n1_total").alias("P"), F.col("n0_total").alias("N"))


def roc_points(long: DataFrame, groups_hint: int | None = None) -> DataFrame:
    """(model, threshold, tp, fp, tpr, fpr), one row per distinct score."""
    t = threshold_counts(long, groups_hint)
    return t.select("model", "threshold", "tp", "fp",
                    F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("tpr"),
                    F.try_divide(F.col("fp").cast("double"), F.col("N")).alias("fpr"))


def pr_points(long: DataFrame, groups_hint: int | None = None) -> DataFrame:
    """(model, threshold, tp, fp, precision, recall), one row per distinct score."""
    t = threshold_counts(long, groups_hint)
    return t.select("model", "threshold", "tp", "fp",
                    (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("recall"))


def ranking_metrics(long: DataFrame, groups_hint: int | None = None) -> DataFrame:
    """(model, n_pos, n_neg, roc_auc, average_precision).

    AUC = P(score of a positive > score of a negative) + half the ties
        = sum over values of n1 * (negatives below + n0 / 2) / (P * N)  (K8);
    AP  = sum over descending thresholds of (recall step) * precision
        = sum over values of n1 / P * tp / (tp + fp)                    (K9).
    Both are NULL when a class is absent.
    """
    t = threshold_counts(long, groups_hint)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    g = t.groupBy("model").agg(
        F.first("P").alias("n_pos"), F.first("N").alias("n_neg"),
        F.sum(F.col("n1") * (F.col("n0_before") + F.col("n0") / 2.0)).alias("_u"),
        F.sum(F.when(F.col("n1") > 0, F.col("n1") * prec).otherwise(0.0)).alias("_ap"))
    ok = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return g.select("model", F.col("n_pos").cast("long").alias("n_pos"),
                    F.col("n_neg").cast("long").alias("n_neg"),
                    F.when(ok, F.col("_u") / (F.col("n_pos") * F.col("n_neg"))).alias("roc_auc"),
                    F.when(ok, F.col("_ap") / F.col("n_pos")).alias("average_precision"))


def confusion_metrics(long: DataFrame, threshold: float = 0.5) -> DataFrame:
    """2x2 counts for the rule ``score > threshold`` (a predicted class is the
    arg-max of the two class probabilities, so exactly 0.5 is class 0), with
    precision, recall and F1 set to 0 when undefined (K10)."""
    pred = (F.col("score") > F.lit(threshold))
    y = F.col("y") == 1
    g = long.where(F.col("y").isin(0, 1)).groupBy("model").agg(
        F.sum((pred & y).cast("long")).alias("tp"), F.sum((pred & ~y).cast("long")).alias("fp"),
        F.sum((~pred & ~y).cast("long")).alias("tn"), F.sum((~pred & y).cast("long")).alias("fn"))
    tp, fp, fn = F.col("tp").cast("double"), F.col("fp").cast("double"), F.col("fn").cast("double")
    return g.select("model", "tp", "fp", "tn", "fn",
                    F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
                    F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
                    F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"))
