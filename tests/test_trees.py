"""Histogram trees and fold-fused logistic regression against plain numpy."""

from multiprocessing.pool import ThreadPool

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import blocks as B
from riskframe.operators import logistic as L
from riskframe.operators import trees as T

FEATURES = ["a", "b", "c", "d", "e"]
BOOSTED = T.TreeParams(rounds=6, rate=0.3)
LEAFWISE = T.TreeParams(rounds=5, max_leaves=12, max_depth=12, rate=0.3, l2=0.0, min_hessian=1e-3, min_rows=5, start_at_mean=True,
                        weight_scheme="balanced")
FOREST = T.TreeParams(rounds=5, max_leaves=1024, max_depth=6, l2=0.0, min_hessian=0.0, min_rows=8, forest=True, weight_scheme="balanced")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 5)).round(1)
    x[:, 3] = rng.integers(0, 2, 500)
    x[rng.random(500) < 0.1, 2] = np.nan
    y = (x[:, 0] + np.nan_to_num(x[:, 2]) * x[:, 1] + 0.5 * rng.normal(size=500) > 0.7).astype(int)
    fold = np.array([-1 if i % 5 == 0 else i % 3 for i in range(500)])
    return x, y, fold


def _frame(spark, data):
    rows = [(i, int(y), int(f), *(None if np.isnan(v) else float(v) for v in x)) for i, (x, y, f) in enumerate(zip(*data))]
    return spark.createDataFrame(rows, "id long, y int, fold int, " + ", ".join(f"{c} double" for c in FEATURES)).repartition(7)


@pytest.fixture(scope="module")
def whole(spark, data):
    return B.row_blocks(_frame(spark, data), FEATURES, "y", "id", "fold", [B.HELD_OUT, 0, 1, 2])


@pytest.fixture(scope="module")
def parts(spark, data):
    return B.row_blocks(_frame(spark, data), FEATURES, "y", "id", "fold", [B.HELD_OUT, 0, 1, 2], block_rows=90)


def test_blocks_hold_every_row(whole, parts, data):
    assert whole.blocks.count() == 1 and parts.blocks.count() >= 6
    got = parts.blocks.select(F.explode("ids").alias("id")).collect()
    assert sorted(r.id for r in got) == list(range(500))
    y, fold = data[1:]
    learn = {k: (fold != -1) & (fold != k) for k in (-1, 0, 1, 2)}
    assert parts.counts() == whole.counts() == {k: (int((y[m] == 0).sum()), int((y[m] == 1).sum())) for k, m in learn.items()}


# ------------------------------------------------------------ plain trees

def _plain_split(codes, g, h, rows, allowed, p):
    """Best (gain, feature, cut) over all cuts, by direct sums."""
    best = (0.0, 0, 0)
    whole = g[rows].sum() ** 2 / (h[rows].sum() + p.l2) if h[rows].sum() + p.l2 else 0.0
    for f in np.flatnonzero(allowed):
        for c in range(T.MAX_BINS - 1):
            left, right = rows[codes[rows, f] <= c], rows[codes[rows, f] > c]
            if not len(right):
                break
            if len(left) < max(1, p.min_rows) or len(right) < max(1, p.min_rows) or h[left].sum() < p.min_hessian or h[right].sum() < p.min_hessian:
                continue
            gain = np.float32(g[left].sum() ** 2 / (h[left].sum() + p.l2) + g[right].sum() ** 2 / (h[right].sum() + p.l2) - whole)
            if gain > max(best[0], np.float32(1e-9)):
                best = (gain, int(f), c)
    return best


def _plain_tree(codes, g, h, p, number):
    """One leaf after another, the largest gain first; a function from codes to values."""
    drawn = np.flatnonzero((h > 0) | (g != 0))
    leaves = {1: drawn}
    value = {1: 0.0}
    splits, gains = {}, {}
    find = lambda place: _plain_split(codes, g, h, leaves[place], T.allowed_columns(p, codes.shape[1], number, place), p)
    gains[1] = find(1)
    while len(leaves) < p.max_leaves:
        place = min(leaves, key=lambda q: (-gains[q][0], q))
        gain, f, c = gains[place]
        if not gain:
            break
        rows = leaves.pop(place)
        splits[place] = (f, c)
        for child, own in ((2 * place, rows[codes[rows, f] <= c]), (2 * place + 1, rows[codes[rows, f] > c])):
            leaves[child], value[child] = own, -g[own].sum() / (h[own].sum() + p.l2)
            gains[child] = find(child) if child.bit_length() - 1 < p.max_depth else (0.0, 0, 0)

    def apply(new):
        out = np.empty(len(new))
        for i, row in enumerate(new):
            place = 1
            while place in splits:
                f, c = splits[place]
                place = 2 * place + (row[f] > c)
            out[i] = value[place]
        return out
    return apply, len(leaves)


def _plain_scores(data, cuts, keys, p, fit):
    x, y, fold = data
    codes = T.to_codes(x, cuts)
    learn, judge = (fold != -1) & (fold != fit), fold == fit
    n1, n0 = int(y[learn].sum()), int((1 - y[learn]).sum())
    w0, w1 = ((n1 + n0) / (2 * n0), (n1 + n0) / (2 * n1)) if p.weight_scheme == "balanced" else (1.0, p.positive_weight)
    weight = np.where(learn, np.where(y > 0, w1, w0), 0.0)
    margin = np.full(len(y), np.log(n1 * w1 / (n0 * w0)) if p.start_at_mean else 0.0)
    total = np.zeros(len(y))
    for t in range(p.rounds):
        g, h = T.gradients(p, t, y, weight, keys, margin)
        apply, _ = _plain_tree(codes, g, h, p, t)
        margin, total = margin + p.rate * apply(codes), total + apply(codes)
    return (total / p.rounds if p.forest else 1 / (1 + np.exp(-margin)))[judge]


def _scores(table, models):
    got = L.score_blocks(table, models).collect()
    return {k: np.array([r.score for r in sorted(got, key=lambda r: r.id) if r.fold == k]) for k in models}


@pytest.mark.parametrize("params", [BOOSTED, LEAFWISE, FOREST], ids=["depth", "leaves", "forest"])
def test_trees_equal_growing_one_leaf_at_a_time(spark, whole, data, params):
    keys = np.array([r.k for r in spark.range(500).select("id", F.xxhash64("id").alias("k")).orderBy("id").collect()])
    models = params.fit_all(whole, [B.HELD_OUT, 1])
    got = _scores(whole, models)
    for k in models:
        assert got[k] == pytest.approx(_plain_scores(data, whole.cuts(T.MAX_BINS), keys, params, k), abs=1e-9)


@pytest.mark.parametrize("params", [BOOSTED, LEAFWISE, FOREST], ids=["depth", "leaves", "forest"])
def test_sums_over_many_blocks_give_the_same_trees(whole, parts, params, monkeypatch):
    monkeypatch.setattr(T, "MARGIN_ROUNDS", 2)
    monkeypatch.setattr(T, "LEAVES_A_PASS", 7)
    one, many = params.fit_all(whole), params.fit_all(parts)
    for k in one:
        assert [t.feature for t in one[k].trees] == [t.feature for t in many[k].trees]
        assert [t.cut for t in one[k].trees] == [t.cut for t in many[k].trees]
        assert _scores(parts, {k: many[k]})[k] == pytest.approx(_scores(whole, {k: one[k]})[k], abs=1e-9)


def test_leaf_and_depth_limits_and_importances(whole):
    boosted, leafwise = BOOSTED.fit_all(whole, [B.HELD_OUT]), LEAFWISE.fit_all(whole, [B.HELD_OUT])
    assert all(len(t.left) <= 2 * 12 - 1 for t in leafwise[B.HELD_OUT].trees)
    for t in boosted[B.HELD_OUT].trees:
        depth = {0: 0}
        for i, (left, right) in enumerate(zip(t.left, t.right)):
            if left >= 0:
                depth[left] = depth[right] = depth[i] + 1
        assert max(depth.values()) <= 5
    shares = boosted[B.HELD_OUT].importances()
    assert shares.sum() == pytest.approx(1.0) and shares[0] > shares[4]


def test_one_class_or_no_rows_give_a_constant(spark):
    frame = spark.createDataFrame([(i, 0, 0, float(i)) for i in range(30)], "id long, y int, fold int, a double")
    table = B.row_blocks(frame, ["a"], "y", "id", "fold", [B.HELD_OUT, 0])
    for p in (BOOSTED, LEAFWISE, FOREST):
        models = p.fit_all(table)
        assert len(set(models[0].score(np.arange(5.0)[:, None]))) == 1  # fold 0 holds every row: nothing to learn from
    assert max(L.LogisticFit().fit_all(table)[B.HELD_OUT].score(np.arange(5.0)[:, None])) < 0.5


# ------------------------------------------------------------ logistic regression

def _filled(spark, data):
    x, y, fold = data
    return np.nan_to_num(x), y, fold


def test_fused_folds_equal_separate_fits(spark, data):
    clean = _filled(spark, data)
    table = B.row_blocks(_frame(spark, clean), FEATURES, "y", "id", "fold", [B.HELD_OUT, 0, 1, 2], block_rows=90)
    fused = L.LogisticFit().fit_all(table)
    alone = {k: L.LogisticFit().fit_all(table, [k])[k] for k in table.fits}
    assert fused[0].passes == max(m.passes for m in alone.values())
    x, y, fold = clean
    for k in table.fits:
        assert fused[k].weights == pytest.approx(alone[k].weights, abs=1e-8)
        learn = (fold != -1) & (fold != k)
        rows, own = np.hstack([x[learn], np.ones((learn.sum(), 1))]), y[learn]
        s = np.where(own > 0, len(own) / (2 * own.sum()), len(own) / (2 * (len(own) - own.sum())))
        w = fused[k].weights
        slope = rows.T @ (s * (1 / (1 + np.exp(-rows @ w)) - own)) + np.append(w[:-1], 0.0)
        assert np.abs(slope).max() < 1e-6  # the optimum of the penalised loss


def test_a_few_blocks_grow_beside_their_fits(spark, data, monkeypatch):
    monkeypatch.setattr(T, "_fit_spread", lambda *_: pytest.fail("a Spark job for each step of growth"))
    few = B.row_blocks(_frame(spark, data), FEATURES, "y", "id", "fold", [B.HELD_OUT, 0], block_rows=150)
    assert 1 < few.blocks.count() <= T.BESIDE_BLOCKS
    for params in (LEAFWISE, FOREST):
        assert len(params.fit_all(few, [B.HELD_OUT])[B.HELD_OUT].trees) == params.rounds


@pytest.mark.parametrize("params", [BOOSTED, LEAFWISE, FOREST], ids=["depth", "leaves", "forest"])
def test_spread_sums_give_the_trees_grown_beside_the_blocks(whole, parts, params, monkeypatch):
    monkeypatch.setattr(T, "LEAVES_A_PASS", 3)
    monkeypatch.setattr(T, "COLUMN_ROWS", 20)
    beside, spread = (T.fit_trees(parts, params, [B.HELD_OUT, 1], spread=how) for how in (False, True))
    one = T.fit_trees(whole, params, [B.HELD_OUT, 1])
    for k in beside:
        assert [(t.feature, t.cut) for t in beside[k].trees] == [(t.feature, t.cut) for t in spread[k].trees] == [(t.feature, t.cut) for t in one[k].trees]


def test_histograms_hold_the_allowed_columns_only():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 9, (300, 25)).astype(np.uint8)
    columns = T._columns(FOREST, 25, 0, [1])
    hist = T.histograms(codes, np.zeros(300, int), columns, rng.normal(size=300), np.ones(300))
    assert columns.shape == (1, 5) and hist.shape == (1, 3, 5, T.MAX_BINS) and (hist[0, 2].sum(-1) == 300).all()


def _leaf_values(params, number, bins, g, h):
    margin = np.zeros(len(g))
    return T._grow_here(params, number, bins, g, h, margin), margin


@pytest.mark.parametrize("params", [BOOSTED, LEAFWISE], ids=["depth", "leaves"])
def test_subtracted_and_bundled_sums_give_the_trees_of_direct_ones(params, monkeypatch):
    rng = np.random.default_rng(4)
    codes = np.stack([rng.integers(1, k, 3000) for k in (3, 250, 4, 90, 2, 6, 8)], 1).astype(np.uint8)
    g, h = rng.normal(size=3000) + (codes[:, 1] > 99) * (codes[:, 0] - 1.0), rng.random(3000)
    g[::7] = h[::7] = 0.0
    bins = T._Bins(codes)
    assert max(len(members) for _, _, members in bins.bundles) > 1
    direct, margin = _leaf_values(params, 0, bins, g, h)
    monkeypatch.setattr(T, "COLUMN_ROWS", 30)
    columns = T._columns(params, 7, 0, [1])
    at = np.flatnonzero(h)
    assert bins.sums(at, columns[0], g, h) == pytest.approx(T.histograms(codes, np.where(h > 0, 0, -1), columns, g, h)[0], abs=1e-9)
    for tree, values in ((direct, margin), _leaf_values(params, 0, bins, g, h)):
        assert (tree.feature, tree.cut) == (direct.feature, direct.cut) and len(tree.left) > 9
        assert values == pytest.approx(params.rate * tree.values(codes), abs=1e-9)


def test_many_blocks_grow_beside_their_fits_while_their_bins_fit_a_task(spark, data, monkeypatch):
    monkeypatch.setattr(T, "_fit_spread", lambda *_: pytest.fail("a Spark job for each step of growth"))
    many = B.row_blocks(_frame(spark, data), FEATURES, "y", "id", "fold", [B.HELD_OUT, 0], block_rows=30)
    assert many.blocks.count() > T.BESIDE_BLOCKS
    for params in (BOOSTED, LEAFWISE, FOREST):
        assert len(params.fit_all(many, [B.HELD_OUT])[B.HELD_OUT].trees) == params.rounds
    monkeypatch.setattr(T, "_fit_spread", lambda coded, width, p, fits, *_: {k: [] for k in fits})
    monkeypatch.setattr(T, "BESIDE_BYTES", 500 * 5 - 1)
    assert LEAFWISE.fit_all(many, [B.HELD_OUT])[B.HELD_OUT].trees == []


def test_models_fitted_side_by_side_share_the_cuts(spark, data):
    table = B.row_blocks(_frame(spark, data), FEATURES, "y", "id", "fold", [B.HELD_OUT, 0])
    with ThreadPool(3) as pool:
        found = pool.map(table.cuts, [T.MAX_BINS] * 3, chunksize=1)
    assert all(cuts is found[0] for cuts in found)

