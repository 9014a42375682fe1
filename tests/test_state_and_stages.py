"""Saved state gives the same rows as the fitted object; a resumed run equals a whole one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import blocks as B
from riskframe.operators import encode
from riskframe.operators.clean import MedianImputer
from riskframe.operators.logistic import LogisticFit, score_blocks
from riskframe.operators.trees import TreeParams
from riskframe.plans.explore import fit_projection
from riskframe.plans.featurize import FeaturePlan
from riskframe.plans.inputs import applicants, table
from riskframe.sources.results import log_rows
from riskframe.sources.stages import StageStore, fingerprint
from riskframe.sources.state import load_state, read_state, save_state, score_frame
from riskframe.sources.tables import read_stage
from riskframe.streaming.score import read_new_rows, score_stream

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def plan(spark):
    return FeaturePlan.fit(applicants(spark, SF), importance_model=lambda df, feats: {f: float(i) for i, f in enumerate(feats)}, top_k=12)


def test_feature_plan_roundtrip(spark, plan, tmp_path):
    assert save_state(spark, f"{tmp_path}/plan", plan) == 1
    back = load_state(spark, f"{tmp_path}/plan")
    assert back == plan
    assert _rows(back.transform(applicants(spark, SF))) == _rows(plan.transform(applicants(spark, SF)))


def test_saved_plan_scores_a_stream(spark, plan, tmp_path):
    save_state(spark, f"{tmp_path}/plan", plan)
    back = load_state(spark, f"{tmp_path}/plan")
    rows = applicants(spark, SF)
    rows.limit(40).write.parquet(f"{tmp_path}/in")
    fixed = spark.read.parquet(f"{tmp_path}/in")
    q = score_stream(read_new_rows(spark, f"{tmp_path}/in", fixed.schema), back.transform, fmt="memory", query_name="plan_stream")
    q.processAllAvailable()
    q.stop()
    assert _rows(spark.table("plan_stream")) == _rows(plan.transform(fixed))


def test_projection_and_small_parts_roundtrip(spark, tmp_path):
    e = table(spark, SF, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(6)])
    names = [f"e{i}" for i in range(6)]
    proj = fit_projection(e, names, "vec_id", restarts=2)
    save_state(spark, f"{tmp_path}/p", proj)
    assert _rows(load_state(spark, f"{tmp_path}/p").transform(e, "vec_id")) == _rows(proj.transform(e, "vec_id"))
    text = spark.createDataFrame([("a", "x", 1.5), ("b", None, None), ("a", "y", -2.0), ("c", "z", 0.1)], "t string, u string, v double")
    for fitted in (MedianImputer.fit(text, ["v"]), encode.CategoryEncoder.fit(text), encode.CategoryEncoder.fit(text, label_max=1, one_hot_max=3),
                   encode.Winsorizer.fit(text, ["v"]), encode.StandardScaler.fit(text, ["v"])):
        path = f"{tmp_path}/{type(fitted).__name__}"
        version = save_state(spark, path, fitted)
        back = load_state(spark, path, version)
        assert back == fitted and _rows(back.transform(text)) == _rows(fitted.transform(text))
    with pytest.raises(TypeError):
        save_state(spark, f"{tmp_path}/q", object())


def test_models_roundtrip(spark, tmp_path):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, int(rng.random() < 0.4), i % 3 - 1, float(rng.normal()), float(rng.normal())) for i in range(200)],
                               "id long, y int, fold int, a double, b double")
    blocks = B.row_blocks(df, ["a", "b"], "y", "id", "fold", [B.HELD_OUT])
    for kind in (LogisticFit(), TreeParams(rounds=4), TreeParams(rounds=3, forest=True, min_rows=5, l2=0.0)):
        model = kind.fit_all(blocks)[B.HELD_OUT]
        save_state(spark, f"{tmp_path}/m", model)
        back = load_state(spark, f"{tmp_path}/m")
        want = {r.id: r.score for r in score_blocks(blocks, {B.HELD_OUT: model}).collect()}
        got = {r.id: r.score for r in score_frame(df.where("fold = -1"), back, ["a", "b"], "id").collect()}
        assert got == want and len(got) == 67


def test_unsealed_versions_are_not_seen(spark, tmp_path):
    path = f"{tmp_path}/s"
    one, two = encode.StandardScaler({"x": (1.0, 2.0)}), encode.StandardScaler({"x": (3.0, 4.0)})
    assert [save_state(spark, path, s) for s in (one, two)] == [1, 2]
    read_state(spark, path, 2).where("part <> 'sealed'").write.parquet(f"{path}/version=3")   # a save that was cut off
    assert load_state(spark, path) == two and load_state(spark, path, 1) == one
    assert save_state(spark, path, one) == 4
    with pytest.raises(FileNotFoundError):
        load_state(spark, path, 3)
    with pytest.raises(FileNotFoundError):
        load_state(spark, f"{tmp_path}/none")


class Killed(Exception):
    pass


def _two_stages(spark, base, source, calls, kill=False):
    store = StageStore(spark, base)

    def first(df):
        calls.append("first")
        return df.withColumn("double", F.col("v") * 2)

    def second(df):
        calls.append("second")
        if kill:
            df.write.parquet(f"{base}/second/run-half")   # a folder that is never committed
            raise Killed
        return df.groupBy("double").count()

    a = store.run("first", [spark.read.parquet(source)], first, {"factor": 2})
    store.log("first", log_rows(spark, "first", "main", {"rows": a.count()}))
    b = store.run("second", [a], second)
    store.log("second", log_rows(spark, "second", "main", {"rows": b.count()}))
    return b, store


def test_killed_and_resumed_run_equals_a_whole_one(spark, tmp_path):
    source = f"{tmp_path}/source"
    spark.createDataFrame([(i % 4,) for i in range(20)], "v long").write.parquet(source)
    whole, _ = _two_stages(spark, f"{tmp_path}/whole", source, [])
    calls = []
    with pytest.raises(Killed):
        _two_stages(spark, f"{tmp_path}/cut", source, calls, kill=True)
    resumed, store = _two_stages(spark, f"{tmp_path}/cut", source, calls)
    assert calls == ["first", "second", "second"]            # the first stage was not computed again
    assert _rows(resumed) == _rows(whole)
    again, _ = _two_stages(spark, f"{tmp_path}/cut", source, calls)
    assert calls == ["first", "second", "second"] and _rows(again) == _rows(whole)
    assert _rows(store.read_log().select("stage", "metric", "value")) == [("first", "rows", 20.0), ("second", "rows", 4.0)]
    folders = [p.name for p in (tmp_path / "cut" / "second").iterdir() if p.name.startswith("run-")]
    assert folders == [store.record("second")["folder"]]     # the unfinished folder is gone


def test_changed_inputs_parameters_or_damage_run_again(spark, tmp_path):
    source = f"{tmp_path}/source"
    spark.createDataFrame([(1,), (2,)], "v long").write.parquet(source)
    store, calls = StageStore(spark, f"{tmp_path}/base"), []

    def build(df):
        calls.append(1)
        return df.withColumn("w", F.col("v") + 1)

    read = lambda: [spark.read.parquet(source)]
    store.run("s", read(), build, {"p": 1})
    store.run("s", read(), build, {"p": 1})
    assert len(calls) == 1
    store.run("s", read(), build, {"p": 2})
    assert len(calls) == 2
    spark.createDataFrame([(3,)], "v long").write.mode("append").parquet(source)
    assert store.run("s", read(), build, {"p": 2}).count() == 3 and len(calls) == 3
    (tmp_path / "base" / "s" / store.record("s")["folder"] / "_SUCCESS").unlink()
    store.run("s", read(), build, {"p": 2})
    assert len(calls) == 4
    assert store.record("s")["rows"] == 3 and store.read("absent") is None
    memory = spark.createDataFrame([(1,)], "v long")
    assert fingerprint(spark, [memory]) == fingerprint(spark, [memory]) != fingerprint(spark, [memory.where("v > 0")])


def test_read_stage_hides_no_other_error(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(FileNotFoundError):
        read_stage(spark, str(tmp_path), "absent")
    with pytest.raises(Exception) as raised:
        read_stage(spark, str(tmp_path), "bad").count()
    assert not isinstance(raised.value, FileNotFoundError)


def test_old_tables_expire(spark):
    from riskframe.session import expire_tables, write_checkpoint_table
    kept = write_checkpoint_table(spark.range(3), "expiring")
    assert expire_tables(spark, hours=24) == 0 and kept.count() == 3
    folder = kept.inputFiles()[0].rsplit("/", 1)[0]
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.setTimes(where, spark._jvm.java.lang.System.currentTimeMillis() - 2 * 3_600_000, -1)
    assert expire_tables(spark, hours=1) == 1 and not fs.exists(where)
