"""Sources and sinks: results JSON, run log, scaler state, stage tables."""

import json

import pytest

from riskframe.operators.encode import StandardScaler
from riskframe.sources.results import append_log, log_rows, read_log, read_results_json
from riskframe.sources.tables import read_csv_table, read_stage, write_csv, write_stage


def test_results_json_to_long(spark, tmp_path):
    doc = {"best_model": "B",
           "test_results": {"A": {"test_auc": 0.7, "test_f1": 0.2}, "B": {"test_auc": 0.8, "test_f1": 0.3}},
           "cv_results": {"A": {"cv_auc_mean": 0.69}}}
    p = tmp_path / "r.json"
    p.write_text(json.dumps(doc))
    rows = {(r.model, r.stage, r.metric): r.value for r in read_results_json(spark, str(p)).collect()}
    assert rows[("B", "test", "test_auc")] == 0.8
    assert rows[("A", "cv", "cv_auc_mean")] == 0.69
    assert read_results_json(spark, str(tmp_path / "missing.json")).count() == 0


def test_run_log_append_and_missing(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(log_rows(spark, "prepare", "main", {"raw_rows": 3, "converted": ["A", "B"]}), path)
    append_log(log_rows(spark, "features", "main", {"scaled_columns": 5}), path)
    got = {(r.stage, r.metric): (r.value, r.text) for r in read_log(spark, path).collect()}
    assert got[("prepare", "converted")] == (2.0, "A,B")
    assert got[("features", "scaled_columns")][0] == 5.0
    assert read_log(spark, str(tmp_path / "none")).count() == 0


def test_scaler_state_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    s = StandardScaler.fit(df, ["x"])
    s.save(spark, str(tmp_path / "scaler"))
    back = StandardScaler.load(spark, str(tmp_path / "scaler"))
    assert back.moments == s.moments == {"x": (2.0, 1.0)}


def test_stage_tables_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, "NA")], "id long, txt string")
    write_stage(df, str(tmp_path), "t1")
    assert read_stage(spark, str(tmp_path), "t1").count() == 2
    with pytest.raises(FileNotFoundError):
        read_stage(spark, str(tmp_path), "absent")
    write_csv(df.toDF("Sk id", "Some-Text"), str(tmp_path / "raw" / "main.csv"))
    back = read_csv_table(spark, str(tmp_path), "main.csv")     # found recursively
    assert back.columns == ["SK_ID", "SOME_TEXT"]
    assert read_csv_table(spark, str(tmp_path), "nope.csv", required=False) is None
