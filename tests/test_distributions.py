"""Tail probabilities as column expressions against the standard library and direct sums."""

import math

import pytest
from pyspark.sql import functions as F

from riskframe.functions.distributions import chi2_p, chi2_sf, normal_p


def test_normal_p_to_twelve_digits(spark):
    zs = [0.0, -1.0, 1e-9, 0.3, 0.999, 1.0, 1.4142, 1.4143, 2.5, 5.0, 12.0, 37.0, 45.0]
    got = spark.createDataFrame([(z,) for z in [*zs, None]], "z double").select("z", normal_p(F.col("z")).alias("p")).collect()
    for r in got:
        if r.z is None:
            assert r.p is None
        else:
            assert r.p == pytest.approx(1.0 if r.z <= 0 else math.erfc(r.z / math.sqrt(2)), rel=1e-12, abs=1e-300)


def test_chi2_p_to_twelve_digits(spark):
    rows = [(s, d) for d in (1, 2, 3, 4, 7, 24, 57, 400, 2001) for s in (0.0, 1e-6, 0.5, 3.84, 30.0, 410.0, 1900.0, 2100.0)]
    got = spark.createDataFrame([*rows, (None, 3), (5.0, 0), (5.0, None)], "s double, d long").select(
        "s", "d", chi2_p(F.col("s"), F.col("d")).alias("p")).collect()
    for r in got:
        if not r.d or r.s is None:
            assert r.p is None
        else:
            assert r.p == pytest.approx(chi2_sf(r.s, float(r.d)), rel=1e-9, abs=1e-290)
    by = {(r.s, r.d): r.p for r in got}
    assert by[3.84, 1] == pytest.approx(math.erfc(math.sqrt(1.92)), rel=1e-12)
    assert by[30.0, 2] == pytest.approx(math.exp(-15.0), rel=1e-12)
    assert by[30.0, 4] == pytest.approx(math.exp(-15.0) * 16, rel=1e-12)
