"""Tiled correlations, bounded levels and the Euclidean silhouette against plain numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import cluster, corr, encode, levels

RNG = np.random.default_rng(2)


def _table(n, p):
    x = RNG.normal(size=(n, p)) + 1e6 * RNG.random(p)
    x[:, 3] = x[:, 1] * 2 + 5
    x[:, 4] = 7.0
    x[RNG.random((n, p)) < 0.15] = np.nan
    return pd.DataFrame(x, columns=[f"c{i}" for i in range(p)])


@pytest.mark.parametrize("tile, pairs", [(128, 32), (7, 3), (5, 1), (40, 2)])
def test_tiled_matrix_equals_pandas(spark, tile, pairs):
    t = _table(150, 40)
    got = corr.correlation_matrix(spark.createDataFrame(t).repartition(4), list(t.columns), tile, pairs).toPandas()
    want = t.corr().to_numpy()
    assert len(got) == 40 * 39 // 2 == len(set(zip(got.i, got.j)))
    for i, j, n, r in zip(got.i, got.j, got.n, got.r):
        both = t.iloc[:, [i, j]].dropna()
        assert n == len(both)
        if 4 in (i, j):
            assert pd.isna(r)
        else:
            assert r == pytest.approx(want[i, j], abs=1e-9)


@pytest.mark.parametrize("width, tile, pairs", [(1, 128, 32), (500, 128, 32), (5000, 128, 32), (90, 10, 4)])
def test_every_tile_pair_is_in_one_group(width, tile, pairs):
    groups = corr.tile_groups(width, tile, pairs)
    tiles = -(-width // tile)
    found = [p for g in groups for p in g]
    assert sorted(found) == [(a, b) for a in range(tiles) for b in range(a, tiles)]
    assert max(map(len, groups)) <= max(pairs, 1)


def test_many_columns_stay_in_tiles(spark):
    base = F.rand(1)
    wide = spark.range(60).select(*[(F.rand(i) + (base if i % 50 == 0 else 0)).alias(f"c{i}") for i in range(700)])
    pairs = corr.correlation_matrix(wide, wide.columns)
    assert pairs.count() == 700 * 699 // 2
    one = wide.select("c0", "c699").toPandas().corr().iloc[0, 1]
    assert pairs.where("i = 0 and j = 699").first().r == pytest.approx(one)


def test_bounded_levels(spark):
    rows = [(str(i), f"k{i % 10}", None if i % 2 else "a", None, f"m{i % 11}") for i in range(200)]
    df = spark.createDataFrame(rows, "id string, ten string, some string, none string, eleven string").repartition(5)
    got = levels.bounded_levels(df, df.columns, 10)
    assert got == {"id": None, "ten": [f"k{i}" for i in range(10)], "some": ["a"], "none": [], "eleven": None}
    assert levels.bounded_levels(df, ["some", "none"], 10, "?") == {"some": ["?", "a"], "none": ["?"]}
    assert levels.bounded_levels(df.where("false"), ["ten"], 10) == {"ten": []}
    fitted = encode.CategoryEncoder.fit(df)
    assert sorted(fitted.dropped) == ["eleven", "id"] and list(fitted.one_hot) == ["ten"] and sorted(fitted.label) == ["none", "some"]


def test_id_like_levels_are_not_shuffled(spark):
    ids = spark.range(0, 20000, 1, 4).select(F.col("id").cast("string").alias("id"))
    found = ids.select(F.col("id").alias("c0")).mapInArrow(lambda b: levels._levels(b, 10), "column int, level string")
    assert found.count() == 4  # one row a task


def _silhouette(x, own):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i, k in enumerate(own):
        same = [j for j in range(len(x)) if own[j] == k and j != i]
        others = [d[i, [j for j in range(len(x)) if own[j] == o]].mean() for o in set(own) - {k}]
        a, b = (d[i, same].mean() if same else 0.0), (min(others) if others else 0.0)
        out.append((b - a) / max(a, b) if same and others and max(a, b) > 0 else 0.0)
    return out


@pytest.mark.parametrize("own", [lambda i: i % 3, lambda i: 0 if i else 1, lambda i: 5])
def test_silhouette_equals_all_pairs(spark, monkeypatch, own):
    monkeypatch.setattr(cluster, "SILHOUETTE_BLOCK", 16)
    x = RNG.normal(size=(70, 4))
    kinds = [own(i) for i in range(70)]
    df = spark.createDataFrame([(i, kinds[i], *map(float, x[i])) for i in range(70)], "id long, k int, a double, b double, c double, d double")
    got = {r.id: r.silhouette for r in cluster.silhouette_rows(df.repartition(3), ["a", "b", "c", "d"], "k", "id").collect()}
    assert [got[i] for i in range(70)] == pytest.approx(_silhouette(x, kinds), abs=1e-12)
    part = cluster.silhouette_rows(df, ["a", "b", "c", "d"], "k", "id", sample_size=30).collect()
    at = sorted(r.id for r in part)
    want = dict(zip(at, _silhouette(x[at], [kinds[i] for i in at])))
    assert len(part) == 30 and {r.id: r.silhouette for r in part} == pytest.approx(want, abs=1e-12)


def test_certificate_finds_moved_centres_and_wrong_rows(spark):
    df = spark.createDataFrame([(0.0, 0), (2.0, 0), (10.0, 1), (12.0, 1)], "x double, CLUSTER_ID int")
    rows = lambda centres, f=df: {r.cluster: (r.nearest, r.centred) for r in cluster.kmeans_certificate(f, ["x"], centres).collect()}
    assert rows([[1.0], [11.0]]) == {0: (True, True), 1: (True, True)}
    assert rows([[1.5], [11.0]]) == {0: (True, False), 1: (True, True)}
    wrong = df.union(spark.createDataFrame([(9.0, 0)], df.schema))
    assert rows([[11.0 / 3], [11.0]], wrong) == {0: (False, True), 1: (True, True)}


@pytest.mark.parametrize("p, n", [(30, 200), (5, 40), (400, 60), (3, 2)])
def test_subspace_iteration_equals_the_gram_matrix(spark, p, n):
    x = RNG.normal(size=(n, p)) * np.linspace(3, 1, p) + 5
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{i}" for i in range(p)])).repartition(3)
    k = min(2, p, n - 1)
    got, shares = cluster.pca_subspace(df, df.columns, k)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    want = cluster._signed(vectors[:, ::-1][:, :k])
    assert got == pytest.approx(want, abs=1e-7)
    assert shares == pytest.approx((values[::-1][:k] / values.sum()).tolist(), rel=1e-9)


def test_wide_tables_take_the_subspace_path(spark, monkeypatch):
    monkeypatch.setattr(cluster, "GRAM_COLUMNS", 4)
    x = RNG.normal(size=(80, 6)) * [4, 3, 1, 1, 1, 1]
    df = spark.createDataFrame(pd.DataFrame(x - x.mean(0), columns=list("abcdef")))
    wide, shares = cluster.pca_fit(df, df.columns, 2)
    monkeypatch.setattr(cluster, "GRAM_COLUMNS", 100)
    narrow, same = cluster.pca_fit(df, df.columns, 2)
    assert wide == pytest.approx(narrow, abs=1e-7) and shares == pytest.approx(same, rel=1e-9)
