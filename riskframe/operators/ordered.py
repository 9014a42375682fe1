"""Exact order statistics without a one-task window.

Everything rank-based in riskframe -- average ranks, exact quantiles, rank
tests, ROC/PR curves, AUC, average precision, hash-ordered sampling and the
stratified split -- reduces to one question: for each row, how much weight lies
strictly before it in a total order inside its group?

A bare ``Window.partitionBy(group).orderBy(value)`` answers it by pulling a
whole group into one task, which does not survive a group holding a third of a
100 TB table.  Here the order is cut into value buckets from approximate cut
points (``percentile_approx`` per group, a bounded sketch); bucket totals are a
small table whose exclusive running sum gives each bucket's offset; the
remaining window runs per (group, bucket), so its size is bounded by the bucket
width, not by the group.  Buckets are a pure function of the value, so a rerun
after a lost executor reproduces the same layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups whose cut-point table is broadcast by hint; above this, or when the
# group count is unknown, a plain join lets AQE choose broadcast from the
# measured size at run time (spark.sql.adaptive.autoBroadcastJoinThreshold).
BROADCAST_GROUPS = 20000


# Rows a (group, bucket) window may hold: one task sorts it.
TARGET_BUCKET_ROWS = 50_000
MAX_BUCKETS = 4096
# Above this size (groups x cut points x 8 bytes) the cut table is not broadcast.
BROADCAST_CUT_BYTES = 64 << 20


def _bucket_count(df: DataFrame, buckets: int | None) -> int:
    """Cut points per group: explicit, else the shuffle partition count (a
    cluster job sizes that to its data), clamped to [16, MAX_BUCKETS]."""
    if buckets:
        return max(1, int(buckets))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(16, min(MAX_BUCKETS, parts))


def _join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                small_rows: int | None = None) -> DataFrame:
    """Join a per-group side table; broadcast only when its row count is bounded."""
    if small_rows is not None and small_rows <= BROADCAST_GROUPS:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def cumulative_before(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                      weights: Sequence[str], buckets: int | None = None,
                      groups_hint: int | None = None) -> DataFrame:
    """Add ``<w>_before`` (weight strictly before the row in the order) and
    ``<w>_total`` (weight in the row's group) for each weight column.

    ``order[0]`` must be numeric; it decides the bucket.  Further order columns
    only break ties inside a bucket (equal ``order[0]`` values always share a
    bucket).  Rows equal in every order column are *not* separated: feed
    distinct (group, value) rows for tie-aware statistics.
    ``groups_hint`` bounds the number of groups (keys); when it is unknown no
    broadcast is forced and AQE decides from the materialised size.
    """
    keys, order, weights = list(keys), list(order), list(weights)
    original = list(df.columns)
    if not keys:  # one group: an explicit constant key keeps every join an equi-join
        df = df.withColumn("_g", F.lit(0))
        keys = ["_g"]
        groups_hint = 1
    nb = _bucket_count(df, buckets)
    adaptive = not buckets
    v = F.col(order[0])
    probs = [i / nb for i in range(1, nb)]
    accuracy = max(10000, 8 * nb)

    if probs:
        # counting over every weight column (never all NULL) keeps this branch's input plan
        # identical to the main branch's, so an aggregated input's shuffle is
        # reused (ReusedExchange) instead of re-scanned.  On a one-split local
        # input two scans would run side by side on idle cores and finish
        # sooner; on a cluster the second scan doubles the input I/O.
        cuts = df.groupBy(*keys).agg(
            F.percentile_approx(v.cast("double"), probs, accuracy).alias("_cuts"),
            F.count(F.coalesce(*[F.col(w) for w in weights])).alias("_rows"))
        if adaptive:
            # keep every step-th cut so that a bucket holds ~TARGET_BUCKET_ROWS rows
            need = F.least(F.lit(nb), F.greatest(F.lit(1), F.ceil(F.col("_rows") / TARGET_BUCKET_ROWS)))
            step = F.ceil(F.lit(nb) / need)
            kept = F.filter("_cuts", lambda c, i: (i + 1) % step == 0)
        else:
            kept = F.col("_cuts")
        cuts = cuts.select(*keys, F.array_distinct(kept).alias("_cuts"))
        n_groups = groups_hint
        small = n_groups is not None and n_groups * nb * 8 <= BROADCAST_CUT_BYTES
        x = _join_small(df, cuts, keys, "inner", n_groups if small else None)
        x = x.withColumn("_bucket", F.size(F.filter("_cuts", lambda c: c < v.cast("double"))))
        x = x.drop("_cuts")
    else:
        n_groups = groups_hint
        x = df.withColumn("_bucket", F.lit(0))

    # per-bucket totals: one row per (group, bucket) -> offsets by a small window
    tot = x.groupBy(*keys, "_bucket").agg(*[F.sum(w).alias(f"_bt_{w}") for w in weights])
    gw = Window.partitionBy(*keys)
    bw = gw.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(
        *keys, "_bucket",
        *[F.coalesce(F.sum(f"_bt_{w}").over(bw), F.lit(0)).alias(f"_off_{w}") for w in weights],
        *[F.sum(f"_bt_{w}").over(gw).alias(f"{w}_total") for w in weights])
    x = _join_small(x, tot, keys + ["_bucket"], "inner",
                    None if n_groups is None else n_groups * nb)

    inner = (Window.partitionBy(*keys, "_bucket").orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, -1))
    return x.select(
        *original,
        *[(F.coalesce(F.sum(w).over(inner), F.lit(0)) + F.col(f"_off_{w}")).alias(f"{w}_before")
          for w in weights],
        *[F.col(f"{w}_total") for w in weights])


def value_counts(df: DataFrame, keys: Sequence[str], value: str,
                 weights: dict[str, Column] | None = None) -> DataFrame:
    """Distinct (keys, value) rows with summed weights; NULL values dropped.
    Partial aggregation runs map-side, so a hot value costs one row per task."""
    weights = weights or {"n": F.lit(1)}
    return (df.where(F.col(value).isNotNull())
            .groupBy(*keys, value)
            .agg(*[F.sum(e).cast("long").alias(name) for name, e in weights.items()]))


def ordered_value_counts(df: DataFrame, keys: Sequence[str], value: str,
                         weights: dict[str, Column] | None = None,
                         buckets: int | None = None,
                         groups_hint: int | None = None) -> DataFrame:
    """(keys, value, w..., w_before..., w_total...) with one row per distinct value."""
    weights = weights or {"n": F.lit(1)}
    vc = value_counts(df, keys, value, weights)
    return cumulative_before(vc, keys, [value], list(weights), buckets, groups_hint)


def average_ranks(df: DataFrame, keys: Sequence[str], value: str,
                  buckets: int | None = None, groups_hint: int | None = None) -> DataFrame:
    """(keys, value, n, avg_rank): 1-based average rank of each distinct value
    inside its group (ties share the mean of their positions)."""
    oc = ordered_value_counts(df, keys, value, None, buckets, groups_hint)
    return oc.select(*keys, value, "n",
                     (F.col("n_before") + (F.col("n") + 1) / 2.0).alias("avg_rank"))


def exact_quantiles(long_df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float], buckets: int | None = None,
                    groups_hint: int | None = None, prefix: str = "q",
                    with_counts: bool = False) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / DuckDB
    ``quantile_cont``): position h = (n-1)q, value = v[floor h] + (h - floor h)
    (v[ceil h] - v[floor h]).  One row per group, columns ``q_<p>`` named by
    :func:`quantile_name`.
    """
    keys = list(keys)
    vc = value_counts(long_df, keys, value).withColumn("d", F.lit(1).cast("long"))
    oc = cumulative_before(vc, keys, [value], ["n", "d"], buckets, groups_hint)
    return quantiles_from_counts(oc, keys, value, probs, prefix, with_counts)


def quantiles_from_counts(oc: DataFrame, keys: Sequence[str], value: str,
                          probs: Sequence[float], prefix: str = "q",
                          with_counts: bool = False) -> DataFrame:
    """Pick interpolated quantiles from ordered value counts
    ``(keys, value, n, n_before, n_total[, d_total])``."""
    keys = list(keys)
    lo_hi = []
    conds = []
    for p in probs:
        h = (F.col("n_total") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        inside_lo = (F.col("n_before") <= lo) & (lo < F.col("n_before") + F.col("n"))
        inside_hi = (F.col("n_before") <= hi) & (hi < F.col("n_before") + F.col("n"))
        conds += [inside_lo, inside_hi]
        lo_hi.append((p, inside_lo, inside_hi))
    hit = conds[0]
    for c in conds[1:]:
        hit = hit | c
    picked = oc.where(hit)
    aggs = []
    for p, inside_lo, inside_hi in lo_hi:
        tag = quantile_name(p, prefix)
        aggs += [F.max(F.when(inside_lo, F.col(value))).alias(f"{tag}__lo"),
                 F.max(F.when(inside_hi, F.col(value))).alias(f"{tag}__hi")]
    aggs.append(F.max("n_total").alias("_n"))
    if with_counts:
        aggs.append(F.max("d_total").alias("_d"))
    g = picked.groupBy(*keys).agg(*aggs) if keys else picked.agg(*aggs)
    outs = []
    for p, _, _ in lo_hi:
        tag = quantile_name(p, prefix)
        h = (F.col("_n") - 1) * F.lit(float(p))
        frac = h - F.floor(h)
        lo, hi = F.col(f"{tag}__lo").cast("double"), F.col(f"{tag}__hi").cast("double")
        outs.append(F.when(frac == 0, lo).otherwise(lo + frac * (hi - lo)).alias(tag))
    if with_counts:
        outs += [F.col("_n").alias("n"), F.col("_d").alias("n_distinct")]
    return g.select(*keys, *outs)


def quantile_name(p: float, prefix: str = "q") -> str:
    text = f"{p:.6f}".rstrip("0").rstrip(".").replace(".", "_")
    return f"{prefix}{text}"


def row_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  buckets: int | None = None, groups_hint: int | None = None,
                  name: str = "pos") -> DataFrame:
    """Exact 0-based position of every row inside its group by ``order``
    (``order`` must make rows unique), plus ``<name>_total`` group sizes."""
    x = df.withColumn("_one", F.lit(1).cast("long"))
    out = cumulative_before(x, keys, order, ["_one"], buckets, groups_hint)
    return (out.withColumnRenamed("_one_before", name)
            .withColumnRenamed("_one_total", f"{name}_total").drop("_one"))


def moments_from_counts(counts: DataFrame, keys: Sequence[str], value: str,
                        weights: dict[str, Column], groups_hint: int | None = None) -> DataFrame:
    """Count, mean, sample variance, min and max per group and per weight from
    distinct-value rows ``(keys, value, <weight columns>)`` -- no second scan of
    the raw rows.  ``weights`` maps an output prefix to a per-value count
    expression.  Variance is two-pass (centred on the group mean), so large
    offsets keep their digits."""
    keys = list(keys)
    single = not keys
    if single:   # one group: a constant key keeps both joins equi-joins
        counts, keys, groups_hint = counts.withColumn("_g", F.lit(0)), ["_g"], 1
    v = F.col(value).cast("double")
    first = counts.groupBy(*keys).agg(*[
        e for p, w in weights.items() for e in (
            F.sum(w).alias(f"{p}_count"),
            (F.sum(w * v) / F.sum(w)).alias(f"{p}_mean"),
            F.min(F.when(w > 0, v)).alias(f"{p}_min"),
            F.max(F.when(w > 0, v)).alias(f"{p}_max"))])
    joined = _join_small(counts, first, keys, "inner", groups_hint)
    second = joined.groupBy(*keys).agg(*[
        (F.sum(w * (v - F.col(f"{p}_mean")) * (v - F.col(f"{p}_mean")))
         / (F.sum(w) - 1)).alias(f"{p}_var") for p, w in weights.items()])
    out = first.join(second, keys)
    return out.drop("_g") if single else out
