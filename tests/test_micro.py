"""Hand-made fixtures for the traps listed in the survey (FIXTURES.md part 4)."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions.distributions import chi2_sf, normal_two_sided_p
from riskframe.operators import clean, corr, curves, encode, rollup, stattests
from riskframe.operators.features import engineer_features
from riskframe.operators.ordered import average_ranks, exact_quantiles
from riskframe.operators.profile import class_histogram
from riskframe.operators.report import comparison_table, results_long, selection_scores
from riskframe.plans.explore import fit_projection


def test_average_ranks_ties_and_negative_zero(spark):
    df = spark.createDataFrame([(v,) for v in [3.0, 1.0, 1.0, -0.0, 0.0, 5.0]], "v double")
    r = {row.v: row.avg_rank for row in average_ranks(df, [], "v", buckets=3).collect()}
    assert r[0.0] == 1.5          # -0.0 and 0.0 are one value with two rows
    assert r[1.0] == 3.5
    assert r[3.0] == 5.0 and r[5.0] == 6.0


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_exact_quantiles_match_numpy_for_any_bucketing(spark, buckets):
    rng = random.Random(7)
    vals = [float(rng.randint(0, 50)) for _ in range(997)] + [1e9, -3.5]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", 2.0)], "g string, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    q = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, buckets=buckets).collect()}
    expect = np.quantile(np.array(vals), probs)   # linear interpolation
    for p, e in zip(probs, expect):
        name = "q" + f"{p:.6f}".rstrip("0").rstrip(".").replace(".", "_")
        assert q["a"][name] == pytest.approx(e, rel=1e-12, abs=1e-12)
        assert q["b"][name] == 2.0


def test_rollup_edge_cases(spark):
    rows = [(1, 1.0, "a"), (1, 3.0, "A"), (2, 5.0, None), (None, 9.0, "x.y"), (3, None, "x.y")]
    df = spark.createDataFrame(rows, "id long, x double, c string")
    out = {r.id: r.asDict() for r in rollup.rollup(df, "id", "p", ["x"], ["c"]).collect()}
    assert set(out) == {1, 2, 3}                      # NULL id dropped
    assert out[2]["P_X_STD"] is None                   # one-row group
    assert out[1]["P_C_A"] == 1.0                      # 'a' and 'A' collide after upper-casing
    assert out[2]["P_C_NAN"] == 1.0
    assert out[3]["P_C_X.Y"] == 1.0                    # level with a dot
    for r in out.values():
        shares = [v for k, v in r.items() if k.startswith("P_C_")]
        assert sum(shares) == pytest.approx(1.0)


def test_ext_source_rowwise(spark):
    rows = [(1, None, None, None), (2, 0.5, None, None), (3, 0.2, 0.4, None), (4, 0.1, 0.2, 0.3)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double")
    out, created, fills = engineer_features(df)
    got = {r.SK_ID_CURR: r for r in out.collect()}
    assert got[2].EXT_SOURCE_STD == 0.0 and got[1].EXT_SOURCE_STD == 0.0
    assert got[3].EXT_SOURCE_STD == pytest.approx(math.sqrt(0.02))
    assert got[2].EXT_SOURCE_PROD == 0.5
    # no values at all -> product 1.0 (pandas prod of nothing)
    assert got[1].EXT_SOURCE_PROD == 1.0
    # missing mean is filled with the median of the others
    assert got[1].EXT_SOURCE_MEAN == pytest.approx(np.median([0.5, 0.3, 0.2]))
    assert got[4].EXT_SOURCE_WEIGHTED == pytest.approx(0.5 * 0.2 + 0.25 * 0.1 + 0.25 * 0.3)


def test_correlation_constant_and_disjoint_columns(spark):
    rows = [(1.0, 5.0, None, 1e9 + 1), (2.0, 5.0, None, 1e9 + 2), (3.0, 5.0, 1.0, 1e9 + 3),
            (None, 5.0, 2.0, 1e9 + 5)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    m = {(r.feature_a, r.feature_b): r for r in corr.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    assert m[("a", "b")].r is None                    # constant column: NULL, no error
    assert m[("a", "d")].r == pytest.approx(1.0, abs=1e-12)   # large offset keeps digits
    assert m[("a", "c")].n == 1 and m[("a", "c")].r is None
    t = {r.feature: r.pearson_corr_with_target for r in
         corr.target_correlations(df.withColumn("y", F.lit(1)), ["a"], "y").collect()}
    assert t["a"] is None


def test_chi_square_yates_and_plain(spark):
    rows = [("a", 0)] * 90 + [("a", 1)] * 10 + [("b", 0)] * 70 + [("b", 1)] * 30
    df = spark.createDataFrame(rows, "lvl string, y int")
    with_y = stattests.chi_square_stats(df, ["lvl"], "y", correction=True).first()
    plain = stattests.chi_square_stats(df, ["lvl"], "y", correction=False).first()
    assert plain.chi2 == pytest.approx(12.5)
    assert with_y.chi2 == pytest.approx(11.28125)
    assert with_y.dof == 1 and with_y.n_levels == 2
    assert chi2_sf(12.5, 1) == pytest.approx(0.000406952017, rel=1e-8)


def test_mann_whitney_matches_textbook_formula(spark):
    rng = random.Random(3)
    x0 = [float(rng.randint(0, 9)) for _ in range(40)]
    x1 = [float(rng.randint(2, 11)) for _ in range(30)]
    df = spark.createDataFrame([(v, 0) for v in x0] + [(v, 1) for v in x1], "v double, y int")
    r = stattests.mann_whitney(df, ["v"], "y").first()
    allv = np.array(x0 + x1)
    order = allv.argsort(kind="mergesort")
    ranks = np.empty(len(allv))
    ranks[order] = np.arange(1, len(allv) + 1)
    for val in np.unique(allv):                       # average ranks for ties
        ranks[allv == val] = ranks[allv == val].mean()
    u0 = ranks[:40].sum() - 40 * 41 / 2
    _, t = np.unique(allv, return_counts=True)
    n = 70
    s = math.sqrt(40 * 30 / 12 * ((n + 1) - (t ** 3 - t).sum() / (n * (n - 1))))
    z = (max(u0, 1200 - u0) - 600 - 0.5) / s
    assert r.u_stat == pytest.approx(u0)
    assert r.z == pytest.approx(z)
    assert r.p_value == pytest.approx(normal_two_sided_p(z))


def test_auc_symmetry_and_ties(spark):
    rows = [(0.1, 0), (0.4, 1), (0.35, 0), (0.8, 1), (0.8, 0), (-0.0, 1), (0.0, 0)]
    df = spark.createDataFrame(rows, "s double, y int").withColumn("neg", -F.col("s"))
    m = {r.model: r for r in curves.ranking_metrics(curves.scores_long(df, ["s", "neg"], "y")).collect()}
    assert m["s"].roc_auc + m["neg"].roc_auc == pytest.approx(1.0)
    # brute force: P(pos > neg) + ties / 2
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert m["s"].roc_auc == pytest.approx(brute)


def test_encoder_unseen_level_and_policy(spark):
    rows = [("a", "x", str(i)) for i in range(9)] + [("b", "y", "k"), ("b", None, "m")]
    df = spark.createDataFrame(rows, "c2 string, c3 string, c11 string")
    enc = encode.CategoryEncoder.fit(df, ["c2", "c3", "c11"])
    assert enc.label == {"c2": ["a", "b"]}
    assert enc.one_hot == {"c3": ["UNKNOWN", "x", "y"]}
    assert enc.dropped == ["c11"]
    new = spark.createDataFrame([("b", "z", "q")], "c2 string, c3 string, c11 string")
    row = enc.transform(new).first().asDict()
    assert row == {"c2": 1, "c3_x": 0, "c3_y": 0}       # unseen level -> all zeros


def test_prune_chain(spark):
    rows = [(float(i), float(i), -float(i), float((i * 7) % 5)) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    dropped = {r.feature for r in corr.correlation_prune(corr.correlation_matrix(df, df.columns), 0.95).collect()}
    assert dropped == {"b", "c"}


def test_numeric_parse_rules(spark):
    vals = [" 12 ", "1e3", "1d", "nan", "inf", "1,000", None, "7"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    counts = clean.numeric_share(clean.normalize_placeholders(df), ["s"])
    assert counts["s"] == (7, 3)          # '' is not present; ' 12 ', '1e3', '7' parse


def test_published_selection_arithmetic(spark):
    # the three published models (test AUC, PR-AUC, CV AUC) and their weighted scores
    test = spark.createDataFrame([
        ("Logistic Regression", 0.7623, 0.2416, 0.1675, 0.69, 0.2696),
        ("Random Forest", 0.7575, 0.2441, 0.1784, 0.6304, 0.278),
        ("XGBoost", 0.7809, 0.273, 0.1879, 0.6779, 0.2942)],
        "model string, roc_auc double, average_precision double, precision double, recall double, f1 double")
    folds = spark.createDataFrame([("Logistic Regression", 0, 0.7608, 0.2693),
                                   ("Random Forest", 0, 0.7538, 0.2769),
                                   ("XGBoost", 0, 0.7776, 0.2916)],
                                  "model string, fold int, roc_auc double, f1 double")
    s = {r.model: r.weighted_score for r in selection_scores(results_long(test, folds)).collect()}
    assert s["XGBoost"] == pytest.approx(0.6 * 0.7809 + 0.2 * 0.7776 + 0.2 * 0.273)
    best = [r for r in comparison_table(results_long(test, folds)).collect() if r.rank == 1][0]
    assert best.model == "XGBoost" and best.selected == "Selected"
    # a model without CV uses its test AUC in the CV slot
    s2 = {r.model: r.weighted_score for r in selection_scores(results_long(test, None)).collect()}
    assert s2["Random Forest"] == pytest.approx(0.8 * 0.7575 + 0.2 * 0.2441)


def test_hot_value_and_hot_group_stay_exact(spark):
    """A third of all rows share one value, and one group holds most rows:
    ranks and quantiles stay exact and no bucket layout changes the result."""
    rng = random.Random(11)
    vals = [7.0] * 1000 + [float(rng.randint(0, 5000)) for _ in range(2000)]
    rows = [("hot", v) for v in vals] + [("cold", float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.1, 0.5, 0.9]
    expect = np.quantile(np.array(vals), probs)
    for b in (None, 3, 50):
        q = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, buckets=b).collect()}
        for p, e in zip(probs, expect):
            name = "q" + f"{p:.6f}".rstrip("0").rstrip(".").replace(".", "_")
            assert q["hot"][name] == pytest.approx(e)
        ranks = {r.v: r.avg_rank for r in average_ranks(df.where("g = 'hot'"), [], "v", buckets=b).collect()}
        below = sum(1 for x in vals if x < 7.0)
        ties = sum(1 for x in vals if x == 7.0)
        assert ties >= 1000
        assert ranks[7.0] == below + (ties + 1) / 2.0


def test_null_target_is_an_error_not_a_lost_row(spark):
    from riskframe.operators.sampling import stratified_split
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(40)], "id long, y int")
    with pytest.raises(Exception, match="NULL in target y"):
        stratified_split(df, "id", "y").collect()
    assert stratified_split(df.where("y is not null"), "id", "y").count() == 36


def test_one_hot_levels_that_differ_in_case(spark):
    from riskframe.operators.encode import CategoryEncoder
    df = spark.createDataFrame([(x,) for x in ["A", "B", "b", "C"]], "k string")
    rows = CategoryEncoder.fit(df).transform(df)
    assert len({c.upper() for c in rows.columns}) == len(rows.columns) == 3
    assert sorted(map(tuple, rows.collect())) == [(0, 0, 0), (0, 0, 1), (0, 1, 0), (1, 0, 0)]


def test_rollup_names_that_meet_keep_the_first(spark):
    from riskframe.operators.rollup import rollup
    df = spark.createDataFrame([(1, "B_C", "C"), (1, "x", "C")], "id long, A string, A_B string")
    row = rollup(df, "id", "P").first().asDict()
    assert row["P_A_B_C"] == 0.5


def test_too_many_levels_raise(spark, monkeypatch):
    from riskframe.operators import rollup
    monkeypatch.setattr(rollup, "MAX_LEVELS", 5)
    df = spark.range(20).selectExpr("id", "cast(id as string) AS k")
    with pytest.raises(ValueError, match="'k'"):
        rollup.rollup(df, "id", "P")


def test_missing_log_is_empty_but_a_broken_one_raises(spark, tmp_path):
    from riskframe.sources.results import read_log
    assert read_log(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_log(spark, str(tmp_path / "bad")).count()


def test_chi_square_tail_with_many_degrees_of_freedom():
    from riskframe.functions.distributions import _gamma_q
    # At its mean the tail tends to one half from below as the degrees of freedom grow.
    assert abs(_gamma_q(5e8, 5e8) - 0.5) < 1e-4


def test_class_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(float(v), y) for y in (0, 1) for v in (0, 0, 10, 10)], "x double, y int")
    rows = class_histogram(df, "x", "y", bins=10).collect()
    assert len(rows) == 20 and sum(r["count"] for r in rows) == 8
    assert {r.bin for r in rows if r["count"]} == {0, 9}
    one = class_histogram(df.where("x = 0"), "x", "y", bins=10).collect()
    assert [(r.bin, r["count"]) for r in one] == [(0, 2), (0, 2)]
    with pytest.raises(ValueError, match="two classes"):
        class_histogram(df.withColumn("y", F.monotonically_increasing_id()), "x", "y")


def test_clean_table_counts_what_it_cannot_fill(spark):
    df = spark.sql("SELECT id AS sk_id_curr, CAST(id AS DOUBLE) AS a, IF(id < 5, NULL, timestamp'2020-01-01') AS t, "
                   "IF(id < 2, NULL, true) AS b, IF(id < 3, NULL, 'x') AS s FROM range(10)")
    out, log = clean.clean_table(df, "t")
    assert log["missing_after"] == 7 and log["categorical_imputed"] == 3
    assert out.where("T IS NULL").count() == 5 and out.where("S IS NULL").count() == 0


def test_projection_fits_all_rows_unless_a_sample_is_asked_for(spark):
    df = spark.range(300).select("id", F.sin("id").alias("a"), F.cos("id").alias("b"), (F.col("id") % 7).cast("double").alias("c"))
    whole = fit_projection(df, ["a", "b", "c"], "id", restarts=1)
    part = fit_projection(df, ["a", "b", "c"], "id", sample_size=50, restarts=1)
    assert whole.scaler.moments["c"] != part.scaler.moments["c"]
    assert whole.scaler.moments["c"][0] == pytest.approx(sum(i % 7 for i in range(300)) / 300)
