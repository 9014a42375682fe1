"""Correlation operators.

``F.corr`` raises under ANSI mode on a constant column, so Pearson here is
always ``try_divide(cov, sd*sd)`` or a guarded formula: zero spread -> NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.names import quote
from riskframe.operators.blocks import summed
from riskframe.operators.longform import to_long
from riskframe.operators.ordered import ordered_value_counts


def target_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson r of each feature with the target over rows where both are
    present (pairwise complete), ordered by |r| desc, missing last, then name (D6, F1).
    Long form + stable co-moment aggregates: one groupBy(feature)."""
    long = to_long(df, features, keep=[target]).where(
        F.col("value").isNotNull() & F.col(quote(target)).isNotNull())
    y = F.col(quote(target)).cast("double")
    g = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.covar_pop("value", y).alias("_cov"),
        F.stddev_pop("value").alias("_sx"), F.stddev_pop(y).alias("_sy"))
    r = F.try_divide(F.col("_cov"), F.col("_sx") * F.col("_sy"))
    return g.select("feature", F.when((F.col("_sx") > 0) & (F.col("_sy") > 0), r)
                    .alias("pearson_corr_with_target"), "n")


def order_by_strength(df: DataFrame, col: str = "pearson_corr_with_target") -> DataFrame:
    return df.orderBy(F.abs(F.col(col)).desc_nulls_last(), F.col("feature"))


#: Columns of a tile, and tile pairs whose sums one task holds (6 x 8 bytes x TILE^2 each: 25 MB).
TILE, TILE_PAIRS = 128, 32
_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def tile_groups(width: int, tile: int = TILE, pairs: int = TILE_PAIRS) -> list[list[tuple[int, int]]]:
    """Tile pairs (a <= b) in groups of at most ``pairs``; a group is a square patch, so that it needs few columns."""
    tiles = -(-width // tile)
    side = max(1, int(pairs ** 0.5))
    if tiles * (tiles + 1) // 2 <= pairs:
        return [[(a, b) for a in range(tiles) for b in range(a, tiles)]]
    return [found for top in range(0, tiles, side) for left in range(top, tiles, side)
            if (found := [(a, b) for a in range(top, min(top + side, tiles)) for b in range(max(left, a), min(left + side, tiles))])]


def _gram(batches, tiles: list[tuple[int, int]], places: dict[int, int], widths: dict[int, int], means: np.ndarray):
    """Centred, masked sums of each tile pair over the task's rows; ``places``: each tile's first column among those read."""
    total = {t: np.zeros((6, widths[t[0]], widths[t[1]])) for t in tiles}
    seen = False
    for b in batches:
        for at in range(0, len(b), 4096):
            part = b.slice(at, 4096)
            a = part.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), -1) - means
            m = (~np.isnan(a)).astype(np.float64)
            a = np.where(m > 0, a, 0.0)
            sq, seen = a * a, True
            for (i, j), out in total.items():
                p, q = slice(places[i], places[i] + widths[i]), slice(places[j], places[j] + widths[j])
                out += [m[:, p].T @ m[:, q], a[:, p].T @ m[:, q], m[:, p].T @ a[:, q], sq[:, p].T @ m[:, q], m[:, p].T @ sq[:, q],
                        a[:, p].T @ a[:, q]]
    if seen:
        for (i, j), out in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([out.tobytes()], pa.binary())],
                                             names=["a", "b", "sums"])


def _pairs(batches, width: int, tile: int):
    """Pairs i < j of each summed tile pair, one row of sums each."""
    for batch in batches:
        for a, b, sums in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sums"))):
            i, j = np.arange(a * tile, min((a + 1) * tile, width)), np.arange(b * tile, min((b + 1) * tile, width))
            found = np.frombuffer(sums, np.float64).reshape(6, len(i), len(j))
            at = np.nonzero(i[:, None] < j[None, :])
            yield pa.RecordBatch.from_arrays([pa.array(i[at[0]], pa.int32()), pa.array(j[at[1]], pa.int32())] + [pa.array(f[at]) for f in found],
                                             names=["i", "j", *_SUMS])


def correlation_matrix(df: DataFrame, cols: Sequence[str], tile: int = TILE, tile_pairs: int = TILE_PAIRS) -> DataFrame:
    """Pairwise-complete Pearson correlation of all column pairs i < j.

    Pass 1: global means (one aggregate).  Pass 2: each task turns its rows
    into centred, masked Gram sums of pairs of column tiles with numpy; tile
    pairs are dealt into groups that a task's memory holds whatever the number
    of columns, a group reads its own columns only, and the sums of a tile
    pair are added up by one reducer.  No task holds or emits p x p values and
    shuffle volume is independent of the row count.  Centring first keeps
    digits that raw sums lose at large offsets.
    Returns (i, j, feature_a, feature_b, n, r) with r NULL on zero spread.
    """
    cols = list(cols)
    width = len(cols)
    found = []
    for s in range(0, width, 100):
        found += list(df.agg(*[F.avg(F.col(quote(c)).cast("double")).alias(f"m{i}") for i, c in enumerate(cols[s:s + 100])]).first())
    means = np.array([m if m is not None else 0.0 for m in found], np.float64)
    groups = tile_groups(width, tile, tile_pairs)
    parts = []
    for group in groups:
        own = sorted({t for pair in group for t in pair})
        spans = {t: range(t * tile, min((t + 1) * tile, width)) for t in own}
        read = [i for t in own for i in spans[t]]
        places = {t: read.index(spans[t][0]) for t in own}
        x = df.select(F.array(*[F.col(quote(cols[i])).cast("double") for i in read]).alias("x"))
        parts.append(x.mapInArrow(partial(_gram, tiles=group, places=places, widths={t: len(v) for t, v in spans.items()}, means=means[read]),
                                  "a int, b int, sums binary"))
    tiles = reduce(DataFrame.unionAll, parts)
    s = summed(tiles, ["a", "b"], "sums", sum(map(len, groups))).mapInArrow(
        partial(_pairs, width=width, tile=tile), "i int, j int, " + ", ".join(f"{c} double" for c in _SUMS))
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    vx = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), F.col("n"))
    vy = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), F.col("n"))
    ok = (F.col("n") > 1) & (vx > 0) & (vy > 0)
    # greatest/least skip NULL, so the clamp sits inside the guard
    r = F.when(ok, F.least(F.greatest(cov / F.sqrt(vx * vy), F.lit(-1.0)), F.lit(1.0)))
    lookup = F.array(*[F.lit(c) for c in cols])
    return s.select("i", "j", F.element_at(lookup, F.col("i") + 1).alias("feature_a"),
                    F.element_at(lookup, F.col("j") + 1).alias("feature_b"),
                    F.col("n").cast("long").alias("n"),
                    r.alias("r"))


def correlation_prune(pairs: DataFrame, threshold: float) -> DataFrame:
    """Columns to drop: j is dropped when some earlier i < j has |r| >= threshold,
    whether or not i itself is dropped; missing r never counts (D20)."""
    return (pairs.where((F.col("i") < F.col("j")) & (F.abs("r") >= F.lit(threshold)))
            .groupBy("j", "feature_b").agg(F.min("i").alias("first_match"))
            .select(F.col("feature_b").alias("feature"), F.col("j").alias("position")))


def spearman_with_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Spearman correlation of each feature with a 0/1 target.

    For a binary target the target's own ranks are an affine function of it,
    so Spearman = Pearson(average rank of x, y) over the complete pairs, and
    that needs only per-value counts by class: no row-level join back.
    """
    long = to_long(df, features, keep=[target]).where(
        F.col("value").isNotNull() & F.col(quote(target)).isNotNull())
    y = F.col(quote(target))
    oc = ordered_value_counts(long, ["feature"], "value",
                              {"n": F.lit(1), "n1": (y == 1).cast("int")},
                              groups_hint=len(features))
    rank = F.col("n_before") + (F.col("n") + 1) / 2.0
    mid = (F.col("n_total") + 1) / 2.0
    g = oc.groupBy("feature").agg(
        F.first("n_total").alias("n"), F.first("n1_total").alias("n1"),
        F.sum(F.col("n") * (rank - mid) * (rank - mid)).alias("_srr"),
        F.sum(F.col("n1") * (rank - mid)).alias("_sry"))
    p = F.col("n1") / F.col("n")
    var_y = F.col("n") * p * (1 - p)          # sum of (y - mean y)^2
    r = F.col("_sry") / F.sqrt(F.col("_srr") * var_y)
    return g.select("feature", F.when((F.col("_srr") > 0) & (var_y > 0), r)
                    .alias("spearman_corr_with_target"), F.col("n").cast("long").alias("n"))
