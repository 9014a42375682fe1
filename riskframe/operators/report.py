"""Results tables and the reporting queries behind the dashboard
(K12-K14, L1-L5, E4, E5, F3-F6, B21, H7, D21, D22).

Results are one long table ``(model, stage, metric, value)`` -- stage is
'cv' or 'test' -- so model scores, fold statistics and run-log rows all
append to the same shape; every report is a pivot or filter of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.spec import SCREEN_PRECISION, SCREEN_RECALL, SELECTION_WEIGHTS

TEST_METRICS = ["test_auc", "test_pr_auc", "test_f1", "test_precision", "test_recall"]
CV_METRICS = ["cv_auc_mean", "cv_auc_std", "cv_f1_mean", "cv_f1_std"]


def results_long(test: DataFrame, cv_folds: DataFrame | None) -> DataFrame:
    """Long results from per-model test metrics (model, roc_auc, average_precision,
    precision, recall, f1) and per-fold CV metrics (model, fold, roc_auc, f1);
    CV spread is the population standard deviation over folds (K6, K13)."""
    pairs = [("test_auc", "roc_auc"), ("test_pr_auc", "average_precision"), ("test_f1", "f1"),
             ("test_precision", "precision"), ("test_recall", "recall")]
    t = test.select("model", F.lit("test").alias("stage"), F.inline(F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in pairs])))
    if cv_folds is None:
        return t
    g = cv_folds.groupBy("model").agg(
        F.avg("roc_auc").alias("cv_auc_mean"), F.stddev_pop("roc_auc").alias("cv_auc_std"),
        F.avg("f1").alias("cv_f1_mean"), F.stddev_pop("f1").alias("cv_f1_std"))
    c = g.select("model", F.lit("cv").alias("stage"), F.inline(F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in CV_METRICS])))
    return t.unionByName(c)


def metrics_wide(results: DataFrame, metrics: Sequence[str] = TEST_METRICS + CV_METRICS) -> DataFrame:
    """One row per model, one column per metric (L1); missing metrics are NULL."""
    return results.groupBy("model").pivot("metric", list(metrics)).agg(F.first("value"))


def selection_scores(results: DataFrame, weights: dict[str, float] = SELECTION_WEIGHTS) -> DataFrame:
    """Weighted score .6 test AUC + .2 CV AUC + .2 PR-AUC; a model without CV
    uses its test AUC in the CV slot (K12).  Adds the three contributions (L2)."""
    w = metrics_wide(results)
    cv = F.coalesce(F.col("cv_auc_mean"), F.col("test_auc"))
    return w.select(
        "*",
        (F.lit(weights["test_auc"]) * F.col("test_auc")).alias("contrib_test_auc"),
        (F.lit(weights["cv_auc"]) * cv).alias("contrib_cv_auc"),
        (F.lit(weights["test_pr_auc"]) * F.col("test_pr_auc")).alias("contrib_pr_auc"),
    ).withColumn("weighted_score", F.col("contrib_test_auc") + F.col("contrib_cv_auc")
                 + F.col("contrib_pr_auc"))


def rank_models(scores: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Rank 1 = best weighted score; ties go to the earlier model in ``order``
    (name order by default), like ``max`` over an insertion-ordered dict (E4, F6).
    A handful of rows: a single-partition window is intended."""
    tie = (F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
           if order else F.col("model"))
    w = Window.orderBy(F.col("weighted_score").desc_nulls_last(), tie)
    return scores.withColumn("rank", F.row_number().over(w)).withColumn(
        "selected", F.when(F.col("rank") == 1, F.lit("Selected")).otherwise(F.lit("Other")))


def comparison_table(results: DataFrame, digits: int | None = 4) -> DataFrame:
    """13 columns: model, 10 scores, rank, selected."""
    r = rank_models(selection_scores(results))
    cols = ["cv_auc_mean", "cv_auc_std", "cv_f1_mean", "cv_f1_std", "test_auc", "test_pr_auc",
            "test_f1", "test_precision", "test_recall", "weighted_score"]
    rnd = (lambda c: F.round(F.col(c), digits)) if digits is not None else F.col
    return r.select("model", *[rnd(c).alias(c) for c in cols], "rank", "selected")


def score_contributions(results: DataFrame) -> DataFrame:
    """Wide -> long: (model, component, contribution) (L2)."""
    s = selection_scores(results)
    return s.select("model", "contrib_test_auc", "contrib_cv_auc", "contrib_pr_auc").unpivot(
        "model", ["contrib_test_auc", "contrib_cv_auc", "contrib_pr_auc"], "component", "contribution")


def runner_up_margin(results: DataFrame) -> DataFrame:
    """(best, runner_up, margin) from the ranked scores (E5)."""
    r = rank_models(selection_scores(results))
    w = Window.orderBy("rank")
    return (r.select("model", "rank", "weighted_score",
                     F.lead("model").over(w).alias("runner_up"),
                     F.lead("weighted_score").over(w).alias("_next"))
            .where(F.col("rank") == 1)
            .select(F.col("model").alias("best"), "runner_up",
                    (F.col("weighted_score") - F.col("_next")).alias("margin")))


def leaderboard(results: DataFrame, metric: str) -> DataFrame:
    """Models ordered by one metric, best first, with position (L4)."""
    w = metrics_wide(results)
    return w.select("model", F.col(metric).alias("value"),
                    F.row_number().over(Window.orderBy(F.col(metric).desc_nulls_last(), "model"))
                    .alias("position"))


def screening_quadrant(results: DataFrame, recall_line: float = SCREEN_RECALL,
                       precision_line: float = SCREEN_PRECISION) -> DataFrame:
    """Each model against the recall / precision reference lines (L3)."""
    w = metrics_wide(results)
    return w.select("model", F.col("test_recall").alias("recall"),
                    F.col("test_precision").alias("precision"),
                    (F.col("test_recall") >= recall_line).cast("int").alias("meets_recall"),
                    (F.col("test_precision") >= precision_line).cast("int").alias("meets_precision"))


def top_importances(importances: DataFrame, k: int = 30) -> DataFrame:
    """Top-k features per model by importance (F5); ties by input position."""
    w = Window.partitionBy("model").orderBy(F.col("importance").desc_nulls_last(), "position")
    return importances.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def feature_metadata(features: DataFrame, dropped: DataFrame, importance: DataFrame | None,
                     variance: DataFrame, kept: DataFrame) -> DataFrame:
    """(feature, selected, dropped_corr, importance, variance) ordered by
    importance desc, missing last (D21).  All inputs are per-feature tables."""
    out = (features.join(dropped.select("feature", F.lit(1).alias("_d")), "feature", "left")
           .join(kept.select("feature", F.lit(1).alias("_k")), "feature", "left")
           .join(variance, "feature", "left"))
    if importance is not None:
        out = out.join(importance.select("feature", "importance"), "feature", "left")
    else:
        out = out.withColumn("importance", F.lit(None).cast("double"))
    return out.select("feature", F.coalesce("_k", F.lit(0)).alias("selected"),
                      F.coalesce("_d", F.lit(0)).alias("dropped_corr"), "importance", "variance") \
        .orderBy(F.col("importance").desc_nulls_last(), "feature")


def pipeline_snapshot(log: DataFrame) -> DataFrame:
    """Engineered / dropped / scaled / final feature counts from the run log."""
    keep = ["engineered_features", "dropped_by_correlation", "scaled_columns",
            "clipped_columns", "final_feature_count"]
    return log.where(F.col("metric").isin(keep)).select("stage", "metric", "value")
