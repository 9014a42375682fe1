"""Projection and clustering.

MLlib fits PCA (distributed Gram matrix) and draws the first centres of
k-means; its Lloyd iterations then run for all restarts, and all numbers of
clusters, in the same passes over packed rows.  Projections and centre
distances are plain column expressions built from the fitted loadings and
centres, so scoring every row stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.names import quote
from riskframe.operators.blocks import BLOCK_ROWS, summed
from riskframe.operators.sampling import sample_n
from riskframe.session import write_checkpoint_table
from riskframe.spec import KMEANS_K, KMEANS_K_RANGE, KMEANS_RESTARTS, SEED, SILHOUETTE_ROWS

#: Up to this many columns the Gram matrix (32 MB) is summed and factored whole.
GRAM_COLUMNS = 2048
#: Rows of the sample that meet the whole sample at once: 256 x 5,000 distances are 10 MB.
SILHOUETTE_BLOCK = 256


def _vectors(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def _signed(loadings: np.ndarray) -> np.ndarray:
    """The largest-magnitude loading of each component is positive."""
    top = np.abs(loadings).argmax(axis=0)
    return loadings * np.where(loadings[top, np.arange(loadings.shape[1])] < 0, -1.0, 1.0)


def pca_fit(df: DataFrame, cols: Sequence[str], k: int = 2) -> tuple[np.ndarray, list[float]]:
    """Loadings (p x k) and explained-variance shares.  Input must already be
    centred and scaled (MLlib's transform does not centre).  Signs are fixed so
    the largest-magnitude loading of each component is positive.  Up to
    ``GRAM_COLUMNS`` columns MLlib sums the p x p Gram matrix in one pass; wider
    tables go through :func:`pca_subspace`."""
    if len(cols) > GRAM_COLUMNS:
        return pca_subspace(df, cols, k)
    model = PCA(k=k, inputCol="features", outputCol="pca").fit(_vectors(df, cols).select("features"))
    return _signed(model.pc.toArray().copy()), [float(v) for v in model.explainedVariance.toArray()]


def _gram_times(batches, block: np.ndarray, mean: np.ndarray):
    """The task's part of X' (X block) with centred rows X."""
    total = np.zeros_like(block)
    for b in batches:
        for at in range(0, len(b), 2048):
            x = b.column("x").slice(at, 2048).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(mean)) - mean
            total += x.T @ (x @ block)
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])


def pca_subspace(df: DataFrame, cols: Sequence[str], k: int = 2, extra: int = 6, tolerance: float = 1e-12,
                 max_passes: int = 200, seed: int = SEED) -> tuple[np.ndarray, list[float]]:
    """:func:`pca_fit` without a p x p matrix anywhere (J5): block Krylov iteration with Rayleigh-Ritz.

    A pass sums X'(X Q) for a block Q of k + ``extra`` vectors; the driver
    holds p x (passes x block) numbers, orthogonalises the new block against
    the earlier ones and stops when every wanted pair (value, vector) leaves a
    residual below ``tolerance`` times the largest value.
    """
    p = len(cols)
    found = []
    for s in range(0, p, 100):
        part = [F.col(quote(c)).cast("double") for c in cols[s:s + 100]]
        found.append(df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(part)],
                            *[F.var_samp(c).alias(f"v{i}") for i, c in enumerate(part)]).first())
    n = found[0]["n"]
    mean = np.array([r[f"m{i}"] for r in found for i in range((len(r) - 1) // 2)], np.float64)
    whole = sum(r[f"v{i}"] or 0.0 for r in found for i in range((len(r) - 1) // 2))
    rows = df.select(F.array(*[F.col(quote(c)).cast("double") for c in cols]).alias("x"))
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(p, min(p, k + extra))))[0]
    basis, images = np.empty((p, 0)), np.empty((p, 0))
    for _ in range(max_passes):
        sums = rows.mapInArrow(partial(_gram_times, block=block, mean=mean), "part int, sums binary")
        image = np.frombuffer(summed(sums, ["part"], "sums", 1).first().sums, np.float64).reshape(block.shape) / max(n - 1, 1)
        basis, images = np.hstack([basis, block]), np.hstack([images, image])
        inner = basis.T @ images
        values, turns = np.linalg.eigh((inner + inner.T) / 2)
        values, turns = values[::-1][:k], turns[:, ::-1][:, :k]
        loadings = basis @ turns
        rest = np.linalg.norm(images @ turns - loadings * values, axis=0)
        fresh = image - basis @ (basis.T @ image)
        fresh -= basis @ (basis.T @ fresh)
        q, r = np.linalg.qr(fresh)
        block = q[:, np.abs(np.diag(r)) > 1e-10 * max(values[0], 1e-300)][:, :p - basis.shape[1]]
        if rest.max() <= tolerance * max(values[0], 1e-300) or not block.shape[1]:
            break
    return _signed(loadings), [float(v / whole) if whole else 0.0 for v in values]


def project(df: DataFrame, cols: Sequence[str], loadings: np.ndarray, prefix: str = "PCA_") -> DataFrame:
    """Append ``PCA_1..k`` as linear column expressions."""
    outs = []
    for j in range(loadings.shape[1]):
        e = F.lit(0.0)
        for i, c in enumerate(cols):
            e = e + F.col(quote(c)) * F.lit(float(loadings[i, j]))
        outs.append(e.alias(f"{prefix}{j + 1}"))
    return df.select("*", *outs)


def _first_centres(data: DataFrame, k: int, restarts: int, seed: int, parallelism: int = 4) -> list[np.ndarray]:
    """MLlib's k-means|| centres of each seeded restart, before any Lloyd iteration.  The restarts are independent
    Spark jobs submitted from a few driver threads (like CrossValidator's ``parallelism``)."""
    def begin(r):
        return np.array(KMeans(k=k, seed=seed + r, maxIter=0, initMode="k-means||").fit(data).clusterCenters(), np.float64)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(begin, range(restarts)))


def _matrix_blocks(data: DataFrame) -> DataFrame:
    """The feature vectors as packed matrices of up to ``BLOCK_ROWS`` rows, in no more partitions than cores."""
    rows = data.select(vector_to_array("features").alias("x")).mapInArrow(_pack_matrix, "x binary, width int")
    return write_checkpoint_table(rows, "matrix").coalesce(max(1, data.sparkSession.sparkContext.defaultParallelism))


def _pack_matrix(batches):
    held, n = [], 0

    def settle():
        x = np.concatenate(held)
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([x.shape[1]], pa.int32())], names=["x", "width"])
    for b in batches:
        if len(b):
            held.append(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1))
            n += len(b)
        if n >= BLOCK_ROWS:
            yield settle()
            held, n = [], 0
    if n:
        yield settle()


def _lloyd_sums(batches, runs: list[np.ndarray]):
    """The task's part of a Lloyd step of every run: per centre the rows' sum and number, and the run's squared distances."""
    sums = [np.zeros((len(c), c.shape[1] + 2)) for c in runs]
    for b in batches:
        for packed, width in zip(b.column("x"), b.column("width").to_pylist()):
            whole = np.frombuffer(packed.as_py(), np.float64).reshape(-1, width)
            for at in range(0, len(whole), 4096):
                x = whole[at:at + 4096]
                square = (x * x).sum(1)
                for centres, total in zip(runs, sums):
                    far = (centres * centres).sum(1) - 2.0 * (x @ centres.T)
                    near = far.argmin(1)
                    own = np.zeros((len(x), len(centres)))
                    own[np.arange(len(x)), near] = 1.0
                    total[:, :-2] += own.T @ x
                    total[:, -2] += own.sum(0)
                    total[:, -1] += own.T @ np.maximum(square + far[np.arange(len(x)), near], 0.0)
    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([t.ravel() for t in sums]).tobytes()], pa.binary())], names=["sums"])


def _lloyd(blocks: DataFrame, runs: list[np.ndarray], max_iter: int, tolerance: float = 1e-4) -> list[tuple[np.ndarray, float, np.ndarray]]:
    """(centres, inertia, rows of each centre) of every run: MLlib's Lloyd iterations, all runs in the same passes.

    As in MLlib a run ends when no centre moves further than ``tolerance``, a
    centre without rows stays, and the inertia is that of the last step's
    assignment.  A task returns one row of sums, whatever its rows.
    """
    def step(which):
        parts = blocks.mapInArrow(partial(_lloyd_sums, runs=[centres[i] for i in which]), "sums binary").collect()   # one row per task
        total = sum(np.frombuffer(r.sums, np.float64) for r in parts)
        edges = np.cumsum([centres[i].shape[0] * (centres[i].shape[1] + 2) for i in which])[:-1]
        return [s.reshape(len(centres[i]), -1) for i, s in zip(which, np.split(total, edges))]

    centres, inertia = [c.copy() for c in runs], [0.0] * len(runs)
    going = list(range(len(runs)))
    for _ in range(max_iter):
        still = []
        for i, s in zip(going, step(going)):
            inertia[i], full = float(s[:, -1].sum()), s[:, -2] > 0
            moved = centres[i].copy()
            moved[full] = s[full, :-2] / s[full, -2:-1]
            if not (((moved - centres[i]) ** 2).sum(1) <= tolerance ** 2).all():
                still.append(i)
            centres[i] = moved
        going = still
        if not going:
            break
    sizes = [s[:, -2].astype(np.int64) for s in step(list(range(len(runs))))]
    return list(zip(centres, inertia, sizes))


def _nearest(centres: np.ndarray):
    """A column function: the number of the nearest centre (first on ties) of an array of features."""
    @F.pandas_udf("int")
    def nearest(x: pd.Series) -> pd.Series:
        rows = np.array(x.tolist(), np.float64).reshape(len(x), -1)
        return pd.Series(((centres * centres).sum(1) - 2.0 * (rows @ centres.T)).argmin(1) if len(x) else [], dtype="int32")
    return nearest


def _best_kmeans(data: DataFrame, ks: Sequence[int], restarts: int, seed: int, max_iter: int) -> list[tuple[np.ndarray, float, np.ndarray]]:
    """Per k the least-inertia (centres, inertia, sizes) of ``restarts`` seeded runs; the runs of all ks share each pass over the rows."""
    first = [c for k in ks for c in _first_centres(data, k, restarts, seed)]
    done = _lloyd(_matrix_blocks(data), first, max_iter)
    return [min(done[i * restarts:(i + 1) * restarts], key=lambda run: run[1]) for i in range(len(ks))]


def kmeans_fit(df: DataFrame, cols: Sequence[str], k: int = KMEANS_K,
               restarts: int = KMEANS_RESTARTS, seed: int = SEED, max_iter: int = 300
               ) -> tuple[list[list[float]], float]:
    """Best of ``restarts`` k-means runs (least inertia).  Centres are returned
    ordered by cluster size, largest first, so cluster ids are stable."""
    data = _vectors(df, cols).select("features").cache()
    (centres, cost, sizes), = _best_kmeans(data, [k], restarts, seed, max_iter)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    data.unpersist()
    return [centres[i].tolist() for i in order], float(cost)


def distances_to_centres(df: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]],
                         prefix: str = "DIST_TO_CLUSTER_") -> DataFrame:
    """Euclidean distance of each row to each centre."""
    outs = []
    for j, centre in enumerate(centres):
        sq = F.lit(0.0)
        for c, v in zip(cols, centre):
            d = F.col(quote(c)).cast("double") - F.lit(float(v))
            sq = sq + d * d
        outs.append(F.sqrt(sq).alias(f"{prefix}{j}"))
    return df.select("*", *outs)


def assign_clusters(df: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]],
                    out: str = "CLUSTER_ID") -> DataFrame:
    """Nearest centre (first on ties) plus the distance columns."""
    d = distances_to_centres(df, cols, centres)
    names = [f"DIST_TO_CLUSTER_{j}" for j in range(len(centres))]
    best = F.lit(0)
    best_d = F.col(names[0])
    for j in range(1, len(names)):
        closer = F.col(names[j]) < best_d
        best = F.when(closer, F.lit(j)).otherwise(best)
        best_d = F.when(closer, F.col(names[j])).otherwise(best_d)
    return d.withColumn(out, best.cast("int"))


def silhouette_rows(df: DataFrame, cols: Sequence[str], cluster_col: str, id_col: str,
                    sample_size: int = SILHOUETTE_ROWS, seed: int = SEED) -> DataFrame:
    """(id, cluster, silhouette): the Euclidean silhouette of every row of a sample of at most ``sample_size`` rows.

    With a a row's mean distance to the other sampled rows of its cluster and
    b the least mean distance to another cluster, the silhouette is
    (b - a) / max(a, b), and 0 in a cluster of one row or where there is one
    cluster only.  The sample (a bounded matrix) goes to every task; a task
    takes its sampled rows in blocks against it and adds distances up per
    cluster, so no pair of rows leaves a block.  Rows with a NULL cluster take
    no part; a missing value counts as 0.
    """
    wide = df.select(F.col(quote(id_col)).alias("id"), F.col(quote(cluster_col)).cast("long").alias("cluster"),
                     F.array(*[F.coalesce(F.col(quote(c)).cast("double"), F.lit(0.0)) for c in cols]).alias("x")).where("cluster is not null")
    sample = sample_n(wide, sample_size, "id", seed)
    held = sample.select("cluster", "x").toPandas()     # at most sample_size rows
    matrix = np.array(held["x"].tolist(), np.float64).reshape(-1, len(cols))
    kind = wide.schema["id"].dataType.simpleString()
    return sample.mapInArrow(partial(_silhouettes, sample=matrix, clusters=held["cluster"].to_numpy(np.int64)),
                             f"id {kind}, cluster long, silhouette double")


def _silhouettes(batches, sample: np.ndarray, clusters: np.ndarray):
    kinds, own = np.unique(clusters, return_inverse=True)
    sizes = np.bincount(own, minlength=len(kinds))
    member = np.zeros((len(sample), len(kinds)))
    member[np.arange(len(sample)), own] = 1.0
    for b in batches:
        for at in range(0, len(b), SILHOUETTE_BLOCK):
            part = b.slice(at, SILHOUETTE_BLOCK)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
            mine = np.searchsorted(kinds, part.column("cluster").to_numpy())
            square = np.zeros((len(x), len(sample)))
            for f in range(x.shape[1]):     # differences first: sums of squares would lose the digits of near rows
                square += (x[:, f, None] - sample[None, :, f]) ** 2
            sums = np.sqrt(square) @ member
            rows = np.arange(len(x))
            others = np.where(np.arange(len(kinds)) == mine[:, None], np.inf, sums / sizes)
            b_mean = others.min(axis=1)
            a_mean = sums[rows, mine] / np.maximum(sizes[mine] - 1, 1)
            top = np.maximum(a_mean, b_mean)
            fine = (sizes[mine] > 1) & (len(kinds) > 1) & (top > 0)
            score = np.where(fine, (np.where(fine, b_mean, 0.0) - a_mean) / np.where(fine, top, 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("cluster"), pa.array(score)], names=["id", "cluster", "silhouette"])


def kmeans_k_selection(df: DataFrame, cols: Sequence[str], k_range=KMEANS_K_RANGE,
                       restarts: int = KMEANS_RESTARTS, seed: int = SEED,
                       max_iter: int = 300, id_col: str | None = None, sample_size: int = SILHOUETTE_ROWS) -> list[dict]:
    """Inertia and silhouettes for each k.

    ``silhouette_score`` is the Euclidean silhouette of a sample of at most
    ``sample_size`` rows, drawn by ``id_col`` (by the rows' values where it is
    not given); ``silhouette_squared`` is MLlib's squared-Euclidean one over
    all rows, computed from per-cluster aggregates."""
    rows = []
    named = df.withColumn("_id", F.col(quote(id_col)) if id_col else F.xxhash64(*[quote(c) for c in cols]))
    data = _vectors(named, cols).select("_id", *[quote(c) for c in cols], "features").cache()
    ks = list(range(k_range[0], k_range[1] + 1))
    for k, (centres, cost, _) in zip(ks, _best_kmeans(data.select("features"), ks, restarts, seed, max_iter)):
        scored = data.withColumn("prediction", _nearest(centres)(vector_to_array("features")))
        squared = ClusteringEvaluator(featuresCol="features", predictionCol="prediction",
                                      distanceMeasure="squaredEuclidean").evaluate(scored)
        mean = silhouette_rows(scored, cols, "prediction", "_id", sample_size, seed).agg(F.avg("silhouette")).first()[0]
        rows.append({"k": k, "inertia": float(cost), "silhouette_score": mean, "silhouette_squared": float(squared)})
    data.unpersist()
    return rows


def kmeans_certificate(df: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]], cluster_col: str = "CLUSTER_ID",
                       tolerance: float = 1e-3) -> DataFrame:
    """Whether an assignment is a fixed point of k-means (J7, J9): per cluster (cluster, nearest, centred).

    ``nearest``: no row of the cluster lies nearer to another centre;
    ``centred``: no coordinate of the rows' mean is further than ``tolerance``
    from the centre.  Clusters without rows have no row.
    """
    names = [f"DIST_TO_CLUSTER_{j}" for j in range(len(centres))]
    d = distances_to_centres(df, cols, centres)
    own = F.element_at(F.array(*names), F.col(cluster_col) + 1)
    means = d.groupBy(F.col(cluster_col).alias("cluster")).agg(
        (F.count(F.when(own > F.least(*names) if len(names) > 1 else F.lit(False), 1)) == 0).alias("nearest"),
        F.array(*[F.avg(F.col(quote(c)).cast("double")) for c in cols]).alias("mean"))
    centre = F.element_at(F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres]), F.col("cluster") + 1)
    moved = F.exists(F.zip_with("mean", centre, lambda a, b: F.abs(a - b) > tolerance), lambda far: far)
    return means.select("cluster", "nearest", (~moved).alias("centred"))


def cluster_profile(df: DataFrame, cluster_col: str, cols: Sequence[str],
                    target: str | None) -> DataFrame:
    """Mean of the given features (and the target) per cluster, with sizes."""
    aggs = [F.avg(F.col(quote(c)).cast("double")).alias(c) for c in cols]
    if target:
        aggs.append(F.avg(F.col(quote(target)).cast("double")).alias(target))
    return df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
