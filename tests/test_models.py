"""The shared model stage: one prepared table per split, one metrics pass for all models and folds."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from riskframe.operators import curves
from riskframe.operators import model as M


def _spec(name, reg):
    return M.ModelSpec(name, "balanced", lambda n: LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=20, regParam=reg))


@pytest.fixture(scope="module")
def rows(spark):
    a = F.when(F.col("id") % 13 == 0, None).otherwise((F.col("id") * 37 % 101).cast("double"))
    return spark.range(240).select(
        "id", a.alias("a"), (F.col("id") * 17 % 23).cast("double").alias("b"),
        ((F.col("id") * 37 % 101 + F.col("id") % 40) > 70).cast("int").alias("y"),
        (F.col("id") % 3).cast("int").alias("part"))


def _splits(rows):
    train, test = rows.where("part < 2"), rows.where("part = 2")
    return [(M.HELD_OUT, train, test)] + [(k, train.where(F.col("part") != k), train.where(F.col("part") == k))
                                          for k in range(2)]


def test_every_model_scores_every_row_of_every_split(rows):
    fitted, scored = M.fit_splits([_spec("L", 0.01), _spec("S", 1.0)], _splits(rows), ["a", "b"], "y", "id")
    assert sorted(fitted) == ["L", "S"]
    counts = {(r["model"], r["fold"]): r["count"] for r in scored.groupBy("model", "fold").count().collect()}
    assert counts == {(m, f): 80 for m in "LS" for f in (M.HELD_OUT, 0, 1)}
    assert scored.where("score is null or score < 0 or score > 1").count() == 0


def test_folds_only_for_the_named_models(rows):
    _, scored = M.fit_splits([_spec("L", 0.01), _spec("S", 1.0)], _splits(rows), ["a", "b"], "y", "id", ["S"])
    found = {tuple(r) for r in scored.select("model", "fold").distinct().collect()}
    assert found == {("L", M.HELD_OUT), ("S", M.HELD_OUT), ("S", 0), ("S", 1)}


def test_grouped_metrics_equal_one_group_at_a_time(rows):
    _, scored = M.fit_splits([_spec("L", 0.01)], _splits(rows), ["a", "b"], "y", "id")
    got = {r["fold"]: r for r in M.evaluate(scored, 3).collect()}
    assert sorted(got) == [M.HELD_OUT, 0, 1]
    for fold, r in got.items():
        one = scored.where(F.col("fold") == fold).select("model", "score", "y")
        rank, conf = curves.ranking_metrics(one).first(), curves.confusion_metrics(one).first()
        assert r["roc_auc"] == pytest.approx(rank["roc_auc"])
        assert r["average_precision"] == pytest.approx(rank["average_precision"])
        assert (r["precision"], r["recall"], r["f1"]) == (conf["precision"], conf["recall"], conf["f1"])


def test_registered_queries_fit_the_reference_settings(spark, monkeypatch):
    """The boosted model of the registered queries has the reference's 300 rounds."""
    from riskframe.plans import driver_queries, modeling
    seen = []
    monkeypatch.setattr(driver_queries, "applicants", lambda spark, sf: None)
    monkeypatch.setattr(modeling, "run_models", lambda df, spec, models, cv_models=None: seen.extend(models))
    driver_queries._model_run(None, "")
    boosted = [m.build(100) for m in seen if m.name == "Boosted Trees"]
    assert [m.getMaxIter() for m in boosted] == [300]
