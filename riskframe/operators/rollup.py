"""One-to-many roll-ups to one row per entity, and the joins back.

The numeric statistics and the category shares of a support table come out
of ONE ``groupBy(id).agg`` (the reference merges two separate group-bys);
every aggregate is algebraic, so partial aggregation collapses a hot id to
one row per map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.names import quote
from riskframe.operators.longform import numeric_columns, string_columns
from riskframe.spec import MISSING_LEVEL

_STATS = {
    "MEAN": F.avg,
    "MAX": F.max,
    "MIN": F.min,
    "STD": F.stddev_samp,
}


#: More levels than this over all columns would not fit one output row per id: an error, never a cut.
MAX_LEVELS = 20_000


def discover_levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Distinct non-missing levels of each text column in one job (sorted).

    Raises when there are more than ``MAX_LEVELS``, as with an id-like column;
    name the columns to roll up instead.
    """
    cols = list(cols)
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(quote(c)).cast("string").alias("l"))
                      for c in cols])
    rows = (df.select(F.inline(pairs)).where(F.col("l").isNotNull())
            .distinct().limit(MAX_LEVELS + 1).collect())
    if len(rows) > MAX_LEVELS:
        most = max(cols, key=lambda c: sum(r["c"] == c for r in rows))
        raise ValueError(f"over {MAX_LEVELS} levels in {cols}; column {most!r} has the most of those seen")
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        out[r["c"]].append(r["l"])
    return {c: sorted(v) for c, v in out.items()}


def rollup_columns(id_col: str, prefix: str, numeric: Sequence[str],
                   levels: dict[str, list[str]],
                   missing_level: str = MISSING_LEVEL) -> list[Column]:
    """Aggregate expressions named ``PREFIX_COL_STAT`` / ``PREFIX_COL_LEVEL`` (upper
    case).  Levels that collide after upper-casing share one column whose
    value is the sum of their shares; of equal names from different columns
    the first is kept."""
    aggs: dict[str, Column] = {}
    for c in numeric:
        if c == id_col:
            continue
        for stat, fn in _STATS.items():
            name = f"{prefix}_{c}_{stat}".upper()
            aggs.setdefault(name, fn(F.col(quote(c)).cast("double")).alias(name))
    for c, lvls in levels.items():
        groups: dict[str, list[str]] = {}
        for lvl in lvls:
            groups.setdefault(f"{prefix}_{c}_{lvl}".upper(), []).append(lvl)
        miss = f"{prefix}_{c}_{missing_level}".upper()
        for name, members in groups.items():
            hit = F.col(quote(c)).isin(members)
            if name == miss:
                hit = hit | F.col(quote(c)).isNull()
            aggs.setdefault(name, F.avg(F.when(hit, 1.0).otherwise(0.0)).alias(name))
        if miss not in groups:
            aggs.setdefault(miss, F.avg(F.when(F.col(quote(c)).isNull(), 1.0).otherwise(0.0)).alias(miss))
    return list(aggs.values())


def rollup(df: DataFrame, id_col: str, prefix: str,
           numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None,
           levels: dict[str, list[str]] | None = None,
           missing_level: str = MISSING_LEVEL) -> DataFrame:
    """Per id: mean, max, min, sample std of every numeric column and the share
    of rows at each level of every text column, plus a missing level.  Rows with
    a missing id are dropped (pandas group-by semantics).  With nothing to
    aggregate the result is the distinct ids (D3)."""
    if id_col not in df.columns:
        raise ValueError(f"roll-up {prefix!r} needs the id column {id_col!r}")
    numeric = [c for c in (numeric_columns(df) if numeric is None else numeric) if c != id_col]
    categorical = [c for c in (string_columns(df) if categorical is None else categorical)
                   if c != id_col]
    if levels is None:
        levels = discover_levels(df, categorical)
    aggs = rollup_columns(id_col, prefix, numeric, {c: levels.get(c, []) for c in categorical},
                          missing_level)
    base = df.where(F.col(quote(id_col)).isNotNull())
    if not aggs:
        return base.select(id_col).distinct()
    return base.groupBy(id_col).agg(*aggs)


def join_rollups(main: DataFrame, rollups: Sequence[DataFrame], id_col: str) -> DataFrame:
    """Left join each roll-up (unique on id) to the main table (C1).  Unmatched
    entities keep NULLs.  Columns already present on the left win (B12).

    Both sides are hash-partitioned on the id by their own shuffle, so the
    second join reuses the first one's partitioning; AQE turns a small roll-up
    into a broadcast at run time.
    """
    out = main
    for r in rollups:
        have = {c.upper() for c in out.columns}
        extra = [c for c in r.columns if c != id_col and c.upper() not in have]
        out = out.join(r.select(id_col, *[quote(c) for c in extra]), id_col, "left")
    return out
