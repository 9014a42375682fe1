"""End-to-end plans on small inputs derived from the driver tables."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import clean, encode
from riskframe.plans.inputs import CUSTOMER_MAIN, applicants, derived, table
from riskframe.plans.prepare import prepare
from riskframe.spec import TableSpec

SF = "/root/testdata/sf0.001"


def test_prepare_keeps_every_main_row_and_skips_missing_tables(spark):
    c = derived(spark, SF, CUSTOMER_MAIN)
    o = table(spark, SF, "orders").withColumnRenamed("o_custkey", "c_custkey").drop("o_orderdate")
    merged, log = prepare(c, {"ORD": o, "BUREAU": None}, TableSpec("C_CUSTKEY", "TARGET"))
    assert merged.count() == c.count()
    assert merged.select("C_CUSTKEY").distinct().count() == c.count()
    assert "ORD_O_TOTALPRICE_MEAN" in merged.columns
    metrics = {(r.table, r.metric): r.value for r in log.collect()}
    assert metrics[("BUREAU", "skipped_missing_table")] == 1.0
    # numeric roll-up (4 stats) + 3 status levels + 5 priorities + 2 missing levels
    assert metrics[("ORD", "rollup_cols")] == 1 + 2 * 4 + 3 + 1 + 5 + 1


def test_clean_table_log_counts(spark):
    rows = [(1, " N/A ", "3"), (1, " N/A ", "3"), (2, "x", "bad"), (3, None, "5"), (4, "y", None),
            (5, "z", "6"), (6, "z", "7"), (7, "z", "8"), (8, "z", "9"), (9, "z", "10"), (10, "z", "11"), (11, "z", "12")]
    df = spark.createDataFrame(rows, "id long, t string, n string")
    out, log = clean.clean_table(df, "t", TableSpec("ID", "TARGET"))
    assert log["duplicates_removed"] == 1
    assert log["numeric_columns_converted"] == ["N"]      # 9 of 10 non-missing parse: exactly 90%
    assert log["categorical_imputed"] == 2                 # ' N/A ' and NULL
    assert log["numeric_imputed"] == 2                     # 'bad' and NULL
    assert log["missing_after"] == 0
    got = {r.ID: r for r in out.collect()}
    assert got[1].T == "UNKNOWN" and got[2].N == pytest.approx(8.0)   # median of 3, 5..12


def test_scaler_ddof0_and_binary_skip(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 1.0), (3.0, 1.0), (None, 0.0)], "x double, b double")
    s = encode.StandardScaler.fit(df, ["x", "b"])
    assert "b" not in s.moments
    out = [r.x for r in s.transform(df).collect()]
    vals = [v for v in out if v is not None]
    assert sum(vals) == pytest.approx(0.0)
    assert sum(v * v for v in vals) / len(vals) == pytest.approx(1.0)


def test_stream_scoring_applies_frozen_state(spark, tmp_path):
    from riskframe.operators.encode import StandardScaler
    from riskframe.streaming.score import read_new_rows, score_stream
    c = table(spark, SF, "customer").select("c_custkey", "c_acctbal")
    scaler = StandardScaler.fit(c, ["c_acctbal"])
    src = str(tmp_path / "incoming")
    c.limit(20).write.parquet(src)
    q = score_stream(read_new_rows(spark, src, c.schema), scaler.transform, fmt="memory",
                     query_name="scored_test")
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM scored_test").count()
    assert got == 20


def test_feature_plan_fit_on_train_applies_to_test(spark):
    from riskframe.operators import sampling
    from riskframe.plans.featurize import FeaturePlan
    a = applicants(spark, SF)
    split = sampling.stratified_split(a, "SK_ID_CURR", "TARGET")
    train = split.where("is_test = 0").drop("is_test", "fold")
    test = split.where("is_test = 1").drop("is_test", "fold")
    plan = FeaturePlan.fit(train, importance_model=lambda df, feats: {f: float(i) for i, f in enumerate(feats)},
                           top_k=5)
    out = plan.transform(test)
    assert out.columns[:2] == ["SK_ID_CURR", "TARGET"]
    assert len(out.columns) == 2 + 5
    assert out.count() == test.count()
    assert plan.log["engineered_features"] == 22
    # no kept pair is correlated at or above the threshold on the training rows
    from riskframe.operators import corr
    t = plan.transform(train)
    pairs = corr.correlation_matrix(t, plan.kept).collect()
    assert all(r.r is None or abs(r.r) < 0.95 for r in pairs)
