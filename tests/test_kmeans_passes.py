"""k-means restarts that share the passes over the rows."""

from functools import partial

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans

from riskframe.operators import cluster as C

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    x = np.random.default_rng(5).normal(size=(400, 3)) + np.repeat(np.eye(3) * 2, [100, 100, 200], axis=0)[:, [2, 0, 1]]
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double").repartition(3, "id").cache()


def test_restarts_give_the_model_of_mllib(rows):
    data = C._vectors(rows, NAMES).select("features").cache()
    models = [KMeans(k=3, seed=42 + r, maxIter=300, initMode="k-means||").fit(data) for r in range(4)]
    best = min(models, key=lambda m: m.summary.trainingCost)
    centres, cost = C.kmeans_fit(rows, NAMES, 3, restarts=4, seed=42)
    assert cost == pytest.approx(best.summary.trainingCost, rel=1e-9)
    assert np.array(sorted(centres)) == pytest.approx(np.array(sorted(c.tolist() for c in best.clusterCenters())), abs=1e-9)


def test_all_runs_share_each_pass(rows, monkeypatch):
    passes, summed = [], C._lloyd_sums
    monkeypatch.setattr(C, "partial", lambda f, **kw: (passes.append(len(kw["runs"])) if f is summed else None) or partial(f, **kw))
    data = C._vectors(rows, NAMES).select("features").cache()
    found = C._best_kmeans(data, [2, 3, 4], 3, 42, 300)
    assert passes[0] == passes[-1] == 9 and len(passes) <= 302
    assert [len(sizes) for _, _, sizes in found] == [2, 3, 4] and all(sizes.sum() == 400 for _, _, sizes in found)


def test_a_centre_without_rows_stays(rows):
    blocks = C._matrix_blocks(C._vectors(rows, NAMES).select("features"))
    far = np.array([[0.0, 0.0, 0.0], [1e6, 1e6, 1e6]])
    (centres, _, sizes), = C._lloyd(blocks, [far], 20)
    assert centres[1].tolist() == far[1].tolist() and sizes.tolist() == [400, 0]


def test_nearest_centre_is_the_first_on_ties(spark):
    near = C._nearest(np.array([[0.0, 0.0], [2.0, 0.0], [2.0, 0.0]]))
    rows = spark.createDataFrame([(0, [1.0, 5.0]), (1, [1.5, 0.0]), (2, [0.5, 0.0])], "id int, x array<double>")
    assert [r.k for r in rows.select("id", near("x").alias("k")).orderBy("id").collect()] == [0, 1, 0]
