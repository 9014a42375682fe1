"""Exploration stage (the reference's task 2): class balance, correlations,
descriptive statistics, rank tests, association tests, histograms, and the
PCA + k-means projection.

The projection is fitted on all rows (or on an exact, reproducible sample of
``sample_size`` rows where the caller asks for one) and then applied to all
rows with the frozen medians, clip bounds, scaler moments, loadings and
centres.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import clean, cluster, corr, encode, profile, sampling, stattests
from riskframe.operators.longform import numeric_columns
from riskframe.session import write_checkpoint_table
from riskframe.spec import KMEANS_K, KMEANS_RESTARTS, SEED, TableSpec


@dataclass
class Projection:
    features: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    clipper: encode.Winsorizer | None = None
    scaler: encode.StandardScaler | None = None
    loadings: object = None
    explained: list[float] = field(default_factory=list)
    centres: list[list[float]] = field(default_factory=list)
    inertia: float | None = None

    def prepare(self, df: DataFrame) -> DataFrame:
        fill = {c: (self.medians.get(c) if self.medians.get(c) is not None else 0.0)
                for c in self.features}
        x = df.select("*", *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(fill[c])))
                             .alias(f"__{i}") for i, c in enumerate(self.features)])
        names = [f"__{i}" for i in range(len(self.features))]
        clip = encode.Winsorizer({f"__{i}": self.clipper.bounds[c]
                                  for i, c in enumerate(self.features) if c in self.clipper.bounds})
        scale = encode.StandardScaler({f"__{i}": self.scaler.moments[c]
                                       for i, c in enumerate(self.features) if c in self.scaler.moments})
        return scale.transform(clip.transform(x)), names

    def transform(self, df: DataFrame, id_col: str) -> DataFrame:
        x, names = self.prepare(df)
        x = cluster.project(x, names, self.loadings)
        x = cluster.assign_clusters(x, names, self.centres)
        k = len(self.centres)
        return x.select(id_col, "PCA_1", "PCA_2", "CLUSTER_ID",
                        *[f"DIST_TO_CLUSTER_{j}" for j in range(k)])


def fit_projection(df: DataFrame, features: Sequence[str], id_col: str,
                   sample_size: int | None = None, k: int = KMEANS_K,
                   restarts: int = KMEANS_RESTARTS, seed: int = SEED) -> Projection:
    """All rows (or a sample) -> non-finite to median then 0 -> clip to their 1%/99%
    (every column) -> drop constant columns -> scale (ddof 0) -> PCA(2) and
    k-means (best of ``restarts``)."""
    rows = df.select(id_col, *features)
    if sample_size is not None:
        rows = sampling.sample_n(rows, sample_size, id_col, seed)
    sample = write_checkpoint_table(rows, "fit_rows")
    medians = clean.column_medians(sample, list(features))
    filled = sample.select(id_col, *[F.coalesce(F.col(f"`{c}`").cast("double"),
                                                F.lit(float(medians[c] if medians[c] is not None else 0.0)))
                                     .alias(c) for c in features])
    clipper = encode.Winsorizer.fit(filled, list(features), skip_binary=False)
    clipped = clipper.transform(filled)
    _, dropped = clean.drop_constant_columns(clipped, list(features))
    kept = [c for c in features if c not in set(dropped)]
    scaler = encode.StandardScaler.fit(clipped, kept, skip_binary=False)
    proj = Projection(kept, {c: medians[c] for c in kept}, clipper, scaler)
    x, names = proj.prepare(sample)
    x = write_checkpoint_table(x.select(*names), "prepared_sample")
    proj.loadings, proj.explained = cluster.pca_fit(x, names, 2)
    proj.centres, proj.inertia = cluster.kmeans_fit(x, names, k, restarts, seed)
    return proj


def eda_tables(df: DataFrame, spec: TableSpec, categoricals: Sequence[str] = (),
               top_tests: int = 12, top_heatmap: int = 6) -> dict[str, DataFrame]:
    """The task-2 tables: class balance, target correlations, describe, rank
    tests on the strongest features, association tests, correlation heatmap."""
    feats = numeric_columns(df, spec.passthrough)
    out = {"class_balance": profile.class_balance(df, spec.target_col)}
    tc = corr.order_by_strength(corr.target_correlations(df, feats, spec.target_col))
    tc = write_checkpoint_table(tc, "target_correlations")
    out["target_correlations"] = tc
    out["describe"] = profile.describe_numeric(df, feats)
    ranked = [r["feature"] for r in corr.order_by_strength(tc).limit(top_tests).collect()]
    out["rank_tests"] = stattests.mann_whitney(df, ranked, spec.target_col)
    if categoricals:
        out["associations"] = stattests.chi_square(df, list(categoricals), spec.target_col)
    out["heatmap"] = corr.correlation_matrix(df, ranked[:top_heatmap])
    return out
