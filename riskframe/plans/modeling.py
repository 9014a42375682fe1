"""Modelling stage (the reference's task 4): stratified 80/20 split, features
fitted on the training rows, stratified k-fold CV, held-out evaluation,
weighted selection and the results / comparison tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import model as M
from riskframe.operators import report, sampling
from riskframe.operators.blocks import row_blocks
from riskframe.operators.clean import MedianImputer
from riskframe.plans.featurize import FeaturePlan
from riskframe.session import write_checkpoint_table
from riskframe.spec import CV_FOLDS, SEED, TEST_SHARE, TableSpec


@dataclass
class ModelRun:
    plan: FeaturePlan
    results: DataFrame          # (model, stage, metric, value)
    comparison: DataFrame       # K14
    importances: DataFrame | None
    models: dict


def split_frame(df: DataFrame, spec: TableSpec, test_share: float = TEST_SHARE,
                folds: int = CV_FOLDS, seed: int = SEED) -> DataFrame:
    """Exact stratified split + folds, written to the checkpoint folder so the
    many fits downstream read a fixed table."""
    return write_checkpoint_table(
        sampling.stratified_split(df, spec.id_col, spec.target_col, test_share, folds, seed), "split")


def fit_features(df: DataFrame, spec: TableSpec | None = None, folds: int = CV_FOLDS, top_k: int = 80,
                 importance_model=None) -> tuple[FeaturePlan, DataFrame]:
    """(feature plan fitted on the training rows, the split table)."""
    spec = spec or TableSpec()
    split = split_frame(df, spec, folds=folds)
    train = split.where(F.col("is_test") == 0)
    plan = FeaturePlan.fit(train.drop("is_test", "fold"), spec, top_k=top_k, importance_model=importance_model)
    return plan, split


def join_sample_features(df: DataFrame, features: DataFrame, id_col: str) -> DataFrame:
    """Per-id features, of a sample or of all rows, left-joined onto every row (C3); columns that ``df`` has stay its own."""
    have = {c.upper() for c in df.columns}
    return df.join(features.select(id_col, *[c for c in features.columns if c.upper() not in have]), id_col, "left")


def run_models(df: DataFrame, spec: TableSpec | None = None,
               models: Sequence[M.ModelSpec] | None = None,
               cv_models: Sequence[str] | None = None, folds: int = CV_FOLDS,
               importance_model=None, top_k: int = 80,
               unsupervised: DataFrame | None = None) -> ModelRun:
    """``unsupervised``: optional per-id projection features (PCA_1, PCA_2,
    CLUSTER_ID, DIST_TO_CLUSTER_i) left-joined onto every row before the split
    (C3); off by default, as the reference documents."""
    spec = spec or TableSpec()
    models = list(models or M.default_models())
    if unsupervised is not None:
        df = join_sample_features(df, unsupervised, spec.id_col)
    plan, split = fit_features(df, spec, folds, top_k, importance_model)
    feats = plan.kept
    fold = F.coalesce("fold", F.lit(M.HELD_OUT)).alias("fold")
    rows = write_checkpoint_table(plan.transform(split, carry=("fold",)).withColumn("fold", fold), "features")
    fused = [m for m in models if hasattr(m.build(1), "fit_all")]
    parts = []
    if fused:
        # Any value still missing gets the training rows' median.
        imputer = MedianImputer.fit(rows.where(F.col("fold") != M.HELD_OUT), feats)
        imputer.medians = {k: (v if v is not None else 0.0) for k, v in imputer.medians.items()}
        table = row_blocks(imputer.transform(rows), feats, spec.target_col, spec.id_col, "fold", [M.HELD_OUT, *range(folds)])
        parts.append(M.fit_folds(fused, table, cv_models))
    if len(fused) < len(models):
        tr, te = rows.where(F.col("fold") != M.HELD_OUT), rows.where(F.col("fold") == M.HELD_OUT)
        splits = [(M.HELD_OUT, tr, te)] + [
            (k, tr.where(F.col("fold") != k), tr.where(F.col("fold") == k)) for k in range(folds)]
        found, scored = M.fit_splits([m for m in models if m not in fused], splits, feats, spec.target_col, spec.id_col, cv_models)
        parts.append((found, scored.withColumnRenamed(spec.id_col, "id")))
    fitted = {name: m for found, _ in parts for name, m in found.items()}
    scored = reduce(DataFrame.unionByName, (s for _, s in parts))
    metrics = write_checkpoint_table(M.evaluate(scored, len(models) * (folds + 1)), "metrics")
    imps = [M.feature_importance(m, feats, name, df.sparkSession)
            for name, m in fitted.items() if hasattr(m, "importances") or hasattr(m, "featureImportances")]
    imps = reduce(DataFrame.unionByName, imps) if imps else None
    held_out = F.col("fold") == M.HELD_OUT
    crossed = cv_models is None or len(cv_models) > 0
    results = report.results_long(metrics.where(held_out), metrics.where(~held_out) if crossed else None)
    return ModelRun(plan, results, report.comparison_table(results), imps, fitted)
