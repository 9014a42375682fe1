"""Bracket quantiles and hash-threshold samples against pandas and plain sorting."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import quantiles as Q
from riskframe.operators import sampling

PROBS = [0, 0.01, 0.25, 0.5, 0.75, 0.99, 1]


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(0)
    n = 6000
    t = pd.DataFrame({"smooth": rng.normal(size=n), "few": rng.integers(0, 3, n).astype(float), "halves": np.where(np.arange(n) % 2, 1.0, 2.0),
                      "hot": np.where(rng.random(n) < 0.9, 7.0, rng.normal(size=n)), "none": np.nan, "signed": rng.choice([-0.0, 0.0, 1.0], n),
                      "wide": 10.0 ** rng.integers(-200, 200, n)})
    t.loc[::7, "smooth"] = np.nan
    return t


@pytest.mark.parametrize("kept, accuracy", [(2000, 10000), (20, 100), (1, 20)])
def test_quantiles_equal_pandas(spark, monkeypatch, table, kept, accuracy):
    monkeypatch.setattr(Q, "KEPT", kept)          # small brackets need several sketches
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    got = Q.column_stats(spark.createDataFrame(table).repartition(5), list(table.columns), PROBS)
    for c in table.columns:
        want = table[c].quantile(PROBS).tolist()
        assert got[c].n == table[c].count() and got[c].more_than_two == (table[c].nunique() > 2)
        if got[c].n:
            assert got[c].quantiles == pytest.approx(want, rel=1e-12)
        else:
            assert got[c].quantiles == [None] * len(PROBS)


def test_quantiles_shuffle_no_column(spark, table):
    """One row has one value, one column none: the smallest tables work; no distinct value is shuffled before the brackets."""
    one = spark.createDataFrame([(5.0, None)], "a double, b double")
    got = Q.column_stats(one, ["a", "b"], [0.5])
    assert got["a"].quantiles == [5.0] and got["b"].quantiles == [None]
    assert Q.column_stats(one.where("a > 9"), ["a"], [0.5])["a"].quantiles == [None]


def _order(ids, seed=42):
    key = lambda i: int(hashlib.md5(f"{'' if i is None else i}:{seed}".encode()).hexdigest()[:15], 16)
    return sorted(ids, key=lambda i: (key(i), i is not None, i or 0))


@pytest.fixture(params=[2000, 3])
def kept(request, monkeypatch):
    monkeypatch.setattr(sampling, "KEPT", request.param)  # 3: cuts need several passes


def test_sample_is_the_start_of_the_hash_order(spark, kept):
    ids = list(range(900))
    df = spark.createDataFrame([(i, i % 4) for i in ids], "id long, y int").repartition(4)
    assert sorted(r.id for r in sampling.sample_n(df, 123, "id").collect()) == sorted(_order(ids)[:123])
    assert sampling.sample_n(df, 900, "id").count() == 900 and sampling.sample_n(df, 0, "id").count() == 0
    got = sampling.sample_n(df, 17, "id", target="y").collect()
    assert sorted(r.id for r in got) == sorted(i for y in range(4) for i in _order([i for i in ids if i % 4 == y])[:17])


def test_repeated_and_missing_ids(spark, kept):
    ids = [5] * 40 + [None] * 3 + list(range(100, 160))
    df = spark.createDataFrame([(i, 0) for i in ids], "id long, y int").repartition(3)
    for n in (1, 20, 43, 60, 103):
        got = [r.id for r in sampling.sample_n(df, n, "id").collect()]
        assert sorted(got, key=str) == sorted(_order(ids)[:n], key=str)
    split = sampling.stratified_split(df, "id", "y").collect()
    assert len({r.is_test for r in split if r.id == 5}) == 1 and len(split) == len(ids)


def test_split_is_exact_and_moves_no_row(spark, kept):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)], "id long, y int").repartition(4)
    split = sampling.stratified_split(df, "id", "y", 0.2, 5)
    rows = split.collect()
    for y, ids in ((0, [i for i in range(1000) if i % 10]), (1, list(range(0, 1000, 10)))):
        order = _order(ids)
        n_test = int(len(ids) * 0.2 + 0.5)
        assert sorted(r.id for r in rows if r.y == y and r.is_test) == sorted(order[:n_test])
        for place, i in enumerate(order[n_test:]):
            row = next(r for r in rows if r.id == i)
            assert row.fold == 5 * place // (len(ids) - n_test)
        sizes = [sum(r.y == y and r.fold == k for r in rows) for k in range(5)]
        assert max(sizes) - min(sizes) <= 1
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_split_of_an_empty_table(spark):
    assert sampling.stratified_split(spark.createDataFrame([], "id long, y int"), "id", "y").count() == 0
    assert spark.createDataFrame([], "id long, y int").select(F.lit(1)).count() == 0
