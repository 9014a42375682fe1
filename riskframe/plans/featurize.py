"""Feature stage: sentinel repair -> engineered features -> categorical encoding
-> 1%/99% clipping -> standard scaling -> correlation pruning -> importance
top-k (the reference's task 3), as one fit/transform object.

Every decision (medians, levels, bounds, moments, kept columns) is fitted on
``fit_on`` rows -- the training rows by default in the modelling plan -- and
applied to any frame by static projections; the fitted state can be saved
and reused to score new rows (A5).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import clean, corr, encode, profile
from riskframe.operators.features import engineer_features
from riskframe.operators.longform import numeric_columns
from riskframe.session import write_checkpoint_table
from riskframe.spec import (
    CORR_PRUNE_THRESHOLD, DAYS_EMPLOYED_SENTINEL, TOP_K_FEATURES, TableSpec,
)


@dataclass
class FeaturePlan:
    spec: TableSpec = field(default_factory=TableSpec)
    sentinel_median: float | None = None
    feature_fills: dict[str, float] = field(default_factory=dict)
    created: list[str] = field(default_factory=list)
    encoder: encode.CategoryEncoder | None = None
    clipper: encode.Winsorizer | None = None
    scaler: encode.StandardScaler | None = None
    dropped_corr: list[str] = field(default_factory=list)
    kept: list[str] = field(default_factory=list)
    importance: dict[str, float] = field(default_factory=dict)
    variance: dict[str, float] = field(default_factory=dict)
    log: dict = field(default_factory=dict)

    def _base(self, df: DataFrame) -> DataFrame:
        if "DAYS_EMPLOYED" in df.columns:
            df, _, _ = clean.sentinel_flag(df, "DAYS_EMPLOYED", DAYS_EMPLOYED_SENTINEL,
                                           median=self.sentinel_median, count=False)
        df, _, _ = engineer_features(df, medians=self.feature_fills or None)
        return df

    @classmethod
    def fit(cls, df: DataFrame, spec: TableSpec | None = None,
            corr_threshold: float = CORR_PRUNE_THRESHOLD, top_k: int = TOP_K_FEATURES,
            importance_model=None, exclude: tuple[str, ...] = (),
            materialize: bool = True) -> "FeaturePlan":
        """``importance_model``: an optional callable (frame, features) -> {feature:
        importance}; without it the correlation-pruned columns are all kept.
        ``exclude``: further columns that are neither features nor passed through
        (e.g. split markers).  ``materialize`` writes the engineered and the scaled
        frames to the shared checkpoint folder, so the many fitting passes read a
        table instead of recomputing the lineage (and survive a lost executor)."""
        plan = cls(spec=spec or TableSpec())
        keep = list(plan.spec.passthrough)
        df = df.drop(*[c for c in exclude if c in df.columns])
        if "DAYS_EMPLOYED" in df.columns:
            n_anom = df.where(F.col("DAYS_EMPLOYED") == DAYS_EMPLOYED_SENTINEL).count()
            df, _, plan.sentinel_median = clean.sentinel_flag(df, "DAYS_EMPLOYED")
            plan.log["days_employed_anomaly_fix"] = n_anom
        df, plan.created, plan.feature_fills = engineer_features(df)
        plan.log["engineered_features"] = len(plan.created)
        if materialize:
            df = write_checkpoint_table(df, "engineered")
        plan.encoder = encode.CategoryEncoder.fit(df, exclude=keep)
        df = plan.encoder.transform(df)
        plan.log.update(binary_encoded=len(plan.encoder.label), one_hot_encoded=len(plan.encoder.one_hot),
                        dropped_high_cardinality=len(plan.encoder.dropped))
        num = numeric_columns(df, keep)
        plan.clipper = encode.Winsorizer.fit(df, num)
        df = plan.clipper.transform(df)
        plan.log["clipped_columns"] = len(plan.clipper.bounds)
        plan.scaler = encode.StandardScaler.fit(df, num)
        df = plan.scaler.transform(df)
        plan.log["scaled_columns"] = len(plan.scaler.moments)
        if materialize:
            df = write_checkpoint_table(df, "scaled")
        feats = numeric_columns(df, keep)
        plan.variance = {r["feature"]: r["variance"] for r in profile.feature_variance(df, feats).collect()}
        pairs = corr.correlation_matrix(df, feats)
        plan.dropped_corr = [r["feature"] for r in corr.correlation_prune(pairs, corr_threshold).collect()]
        kept = [f for f in feats if f not in set(plan.dropped_corr)]
        plan.log["dropped_by_correlation"] = len(plan.dropped_corr)
        if importance_model is not None:
            plan.importance = importance_model(df, kept)
            if top_k > 0:
                order = sorted(range(len(kept)), key=lambda i: (-plan.importance.get(kept[i], 0.0), i))
                kept = [kept[i] for i in order[:top_k]]
        plan.kept = kept
        plan.log["final_feature_count"] = len(kept)
        return plan

    def transform(self, df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
        """Kept features with id and target; ``carry``: further columns to pass through."""
        df = self._base(df)
        df = self.encoder.transform(df)
        df = self.clipper.transform(df)
        df = self.scaler.transform(df)
        keep = [c for c in self.spec.passthrough if c in df.columns]
        return df.select(*keep, *carry, *self.kept)

    def log_frame(self, spark, stage: str = "features") -> DataFrame:
        rows = [(stage, k, float(v)) for k, v in self.log.items()]
        return spark.createDataFrame(rows, "stage string, metric string, value double")
