"""Exact quantiles of many columns by bracket selection.

An exact quantile needs the values at two known ranks only.  A sketch per
column brackets them, and one aggregate counts the rows below and up to both
ends of each bracket, which settles every rank that an end holds.  A bracket
with more than ``KEPT`` rows strictly inside is sketched again there, about
thousand times narrower each time.  At last the few values inside are the only
ones that are shuffled or sent anywhere: nothing grows with the number of
distinct values, and every pass over the table is one wide aggregate with
map-side partial results.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.names import quote
from riskframe.operators.ordered import quantile_name

#: Rows that a settled bracket may hold, and the sketch's relative rank error is 1 / ``ACCURACY``.
KEPT, ACCURACY = 2_000, 10_000
#: Aggregates of one pass: wider ones no longer compile to one loop.
AGGREGATES = 64


@dataclass
class ColumnStats:
    """Non-missing rows, extremes, exact quantiles and whether a third value occurs besides the extremes."""

    n: int
    low: float | None
    high: float | None
    quantiles: list[float | None]
    inner: int = 0

    @property
    def more_than_two(self) -> bool:
        return self.inner > 0


def _value(c: str):
    v = F.col(quote(c)).cast("double")
    return F.when(~F.isnan(v), v + 0.0)  # -0.0 and 0.0 are one value


def _aggregate(df: DataFrame, found: list) -> list:
    """Values of many aggregate expressions, a few passes over the table for very wide ones."""
    out = []
    for s in range(0, len(found), AGGREGATES):
        out += list(df.agg(*[e.alias(f"a{i}") for i, e in enumerate(found[s:s + AGGREGATES])]).first())
    return out


def column_stats(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, ColumnStats]:
    """Exact quantiles with linear interpolation (pandas, ``quantile_cont``) of every column; NULL and NaN take no part.

    A column without values has n = 0 and None everywhere.
    """
    cols, probs = list(dict.fromkeys(cols)), list(probs)
    if not cols:
        return {}
    values = {c: _value(c) for c in cols}
    room = 2.0 / ACCURACY
    around = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-room, room)}) or [0.5]
    sketch = _aggregate(df, [e for v in values.values() for e in (F.count(v), F.min(v), F.max(v), F.percentile_approx(v, around, ACCURACY))])
    stats, known, todo = {}, {c: {} for c in cols}, {}
    for i, c in enumerate(cols):
        n, low, high, cuts = sketch[4 * i:4 * i + 4]
        stats[c] = ColumnStats(n, low, high, [None] * len(probs))
        for p in probs if n else ():
            ends = (low if p <= room else cuts[around.index(p - room)], high if p >= 1 - room else cuts[around.index(p + room)])
            todo.setdefault((c, *ends), set()).update((math.floor((n - 1) * p), math.ceil((n - 1) * p)))
    middle = {c: F.count(F.when((v > stats[c].low) & (v < stats[c].high), 1)) for c, v in values.items() if stats[c].n}
    settled = []
    while todo or middle:
        found = _aggregate(df, [e for c, low, high in todo for e in _counts(values[c], low, high)] + list(middle.values()))
        for c, k in zip(middle, found[4 * len(todo):]):
            stats[c].inner = k
        middle, again, wide = {}, {}, []
        for i, ((c, low, high), ranks) in enumerate(todo.items()):
            under, upto_low, under_high, upto = found[4 * i:4 * i + 4]
            inner = sorted(r for r in ranks if upto_low <= r < under_high)
            for r in ranks:
                if under <= r < upto_low:
                    known[c][r] = low
                elif under_high <= r < upto:
                    known[c][r] = high
                elif r < under:       # the sketch erred by more than it promises
                    again.setdefault((c, -math.inf, low), set()).add(r)
                elif r >= upto:
                    again.setdefault((c, high, math.inf), set()).add(r)
            if inner:
                (settled if under_high - upto_low <= KEPT else wide).append((c, low, high, upto_low, under_high - upto_low, inner))
        ends = _aggregate(df, [F.percentile_approx(
            F.when((values[c] > low) & (values[c] < high), values[c]),
            [max(0.0, (ranks[0] - start) / n - room), min(1.0, (ranks[-1] + 1 - start) / n + room)], ACCURACY)
            for c, low, high, start, n, ranks in wide])
        for (c, *_, ranks), cut in zip(wide, ends):
            again.setdefault((c, *cut), set()).update(ranks)
        todo = again

    for (c, _, _, start, _, ranks), rows in zip(settled, _inside(df, settled, values)):
        for v, n in sorted(rows):
            known[c].update((r, v) for r in ranks if start <= r < start + n)
            start += n
    for c in cols:
        for j, p in enumerate(probs if stats[c].n else ()):
            h = (stats[c].n - 1) * p
            lo, hi, part = known[c][math.floor(h)], known[c][math.ceil(h)], h - math.floor(h)
            stats[c].quantiles[j] = lo if part == 0 else lo + part * (hi - lo)
    return stats


def _counts(v, low: float, high: float) -> list:
    """Rows below and up to either end."""
    return [F.count(F.when(test, 1)) for test in (v < low, v <= low, v < high, v <= high)]


def _inside(df: DataFrame, settled: list, values: dict) -> list[list[tuple[float, int]]]:
    """(value, rows) strictly inside each bracket: at most ``KEPT`` rows a bracket."""
    out: list[list[tuple[float, int]]] = [[] for _ in settled]
    if settled:
        cells = F.array(*[F.struct(F.lit(i).alias("b"), F.when((values[c] > low) & (values[c] < high), values[c]).alias("v"))
                          for i, (c, low, high, *_) in enumerate(settled)])
        rows = df.select(F.inline(F.filter(cells, lambda x: x["v"].isNotNull()))).groupBy("b", "v").agg(F.count("*").alias("n"))
        for r in rows.collect():
            out[r.b].append((r.v, r.n))
    return out


def quantile_frame(df: DataFrame, cols: Sequence[str], probs: Sequence[float], prefix: str = "q") -> DataFrame:
    """(feature, one column per quantile) of :func:`column_stats`; columns without values are left out."""
    stats = column_stats(df, cols, probs)
    names = [quantile_name(p, prefix) for p in probs]
    return df.sparkSession.createDataFrame(
        [(c, *s.quantiles) for c, s in stats.items() if s.n], "feature string, " + ", ".join(f"{n} double" for n in names))
