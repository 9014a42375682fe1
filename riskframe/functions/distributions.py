"""Tail probabilities for the rank and association tests.

Spark SQL has no erf/erfc or incomplete gamma function; :func:`normal_p` and
:func:`chi2_p` are column expressions that evaluate a series, a continued
fraction or a finite sum with ``aggregate``.  The plain functions beside them
serve single values.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_two_sided_p(z: float) -> float:
    """2 * P(Z > z) for z >= 0, clipped to [0, 1]."""
    if z is None or (isinstance(z, float) and math.isnan(z)):
        return float("nan")
    return min(1.0, max(0.0, math.erfc(z / math.sqrt(2.0))))


def _gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): series below a+1, Lentz
    continued fraction above (the textbook split)."""
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1.0:
        term = total = 1.0 / a
        ap = a
        while True:  # terms fall geometrically once ap passes x
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - gln))
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in itertools.count(1):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 3e-16:
            break
    return math.exp(-x + a * math.log(x) - gln) * h


def chi2_sf(stat: float, dof: float) -> float:
    if stat is None or dof is None or dof <= 0 or math.isnan(stat):
        return float("nan")
    return _gamma_q(dof / 2.0, stat / 2.0)


#: Terms of the series (below 1) and of the continued fraction (from 1 on) for erfc: more than doubles can show.
_SERIES, _FRACTION = 40, 200


def erfc(x: Column) -> Column:
    """Complementary error function of a column of values >= 0."""
    sq = x * x
    # erf x = 2 / sqrt(pi) exp(-x^2) (x + 2 x^3 / 3 + 4 x^5 / 15 + ...): no term is negative.
    step = lambda acc, n: F.struct((acc["t"] * 2.0 * sq / (2.0 * n + 1.0)).alias("t"), acc["s"].alias("s"))
    added = lambda acc: F.struct(acc["t"].alias("t"), (acc["s"] + acc["t"]).alias("s"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(_SERIES)), F.struct(x.alias("t"), x.alias("s")),
                         lambda acc, n: added(step(acc, n)), lambda acc: acc["s"])
    # erfc x = exp(-x^2) / sqrt(pi) / (x + (1/2) / (x + (2/2) / (x + (3/2) / (x + ...)))), from the inside out.
    inner = F.aggregate(F.sequence(F.lit(_FRACTION), F.lit(1), F.lit(-1)), F.lit(0.0), lambda t, k: (k / 2.0) / (x + t))
    root = math.sqrt(math.pi)
    return F.when(x < 1.0, 1.0 - 2.0 / root * F.exp(-sq) * series).otherwise(F.exp(-sq) / root / (x + inner))


def normal_p(z: Column) -> Column:
    """2 P(Z > z) for z >= 0 (negative z: 1); NULL for NULL."""
    z = z.cast("double")
    return F.when(z <= 0, 1.0).when(z.isNotNull(), erfc(z / math.sqrt(2.0)))


def chi2_p(stat: Column, dof: Column) -> Column:
    """P(chi-square with ``dof`` degrees of freedom > stat): a finite sum for whole ``dof``; NULL for NULL or no freedom.

    With x = stat / 2: even dof, sum of exp(-x) x^k / k! for k < dof / 2; odd
    dof, erfc(sqrt x) and exp(-x) x^(k - 1/2) / Gamma(k + 1/2) for k < dof / 2.
    Terms are added through their logarithms, so none overflows.
    """
    x, odd = stat.cast("double") / 2.0, F.pmod(dof.cast("long"), F.lit(2)) == 1
    half = F.when(odd, 0.5).otherwise(0.0)
    first = F.when(odd, F.ln(x) / 2.0 - math.lgamma(1.5)).otherwise(0.0) - x
    start = F.when(odd, 1).otherwise(0)
    last = (F.ceil(dof / 2.0) - 1).cast("int")      # the sum's last k
    more = F.when(last > start, F.sequence(start + 1, F.greatest(last, start + 1))).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(
        more, F.struct(first.alias("l"), F.exp(first).alias("s")),
        lambda acc, k: F.struct((acc["l"] + F.ln(x / (k - half))).alias("l"),
                                (acc["s"] + F.exp(acc["l"] + F.ln(x / (k - half)))).alias("s")),
        lambda acc: acc["s"])
    upper = F.when(odd, erfc(F.sqrt(x))).otherwise(0.0) + F.when(last >= start, total).otherwise(0.0)
    return F.when(F.coalesce(dof <= 0, F.lit(True)), None).when(x <= 0, 1.0).when(x.isNotNull(), F.least(upper, F.lit(1.0)))
