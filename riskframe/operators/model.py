"""Supervised modelling.

The default models learn from row blocks (:mod:`riskframe.operators.blocks`):
all folds and the held-out split of a model are fitted side by side, in the
passes of one fit.  Any other model is an MLlib estimator, fitted split by
split.  Every evaluation metric is computed by
:mod:`riskframe.operators.curves` from the scored rows, on the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.names import quote
from riskframe.operators import curves
from riskframe.operators.blocks import HELD_OUT, RowBlocks, row_blocks
from riskframe.operators.clean import MedianImputer
from riskframe.operators.logistic import LogisticFit, score_blocks
from riskframe.operators.trees import TreeParams
from riskframe.session import write_checkpoint_table
from riskframe.spec import BOOSTING_POSITIVE_WEIGHT, SEED


def class_weight_table(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights n / (2 * n_class) per class (K1): (target, n, weight)."""
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())   # over the two class rows
    return g.select(target, "n", (total / (F.lit(2.0) * F.col("n"))).alias("weight"))


def with_weights(df: DataFrame, target: str, scheme: str = "balanced", out: str = "weight") -> DataFrame:
    """Attach a weight column: 'balanced' (two class counts, a tiny driver
    read) or 'positive' (fixed positive-class weight of the boosted model)."""
    y = F.col(quote(target))
    if scheme == "positive":
        return df.withColumn(out, F.when(y == 1, F.lit(BOOSTING_POSITIVE_WEIGHT)).otherwise(1.0))
    counts = {r[0]: r[1] for r in df.groupBy(target).count().collect()}   # two rows
    n = sum(counts.values())
    w0 = n / (2.0 * counts.get(0, 1))
    w1 = n / (2.0 * counts.get(1, 1))
    return df.withColumn(out, F.when(y == 1, F.lit(w1)).otherwise(F.lit(w0)))


@dataclass(frozen=True)
class ModelSpec:
    name: str
    weight_scheme: str
    build: object          # callable (n_train) -> estimator


def default_models(trees: int = 200, boost_iter: int = 300,
                   second_booster: bool = False) -> list[ModelSpec]:
    """The reference's three published models, fitted on row blocks.

    Logistic regression: L2 with C = 1, balanced weights.  Random forest:
    depth 10, at least 50 rows a leaf, balanced weights.  Boosted trees: depth
    5, step 0.05, row and column samples of 0.8, a fixed positive weight.
    ``second_booster`` adds the reference's optional second boosted model (63
    leaves of any depth, at least 20 rows a leaf, balanced weights; it has no
    published result).
    """
    models = [
        ModelSpec("Logistic Regression", "balanced", lambda n: LogisticFit(c=1.0, max_iter=1000)),
        ModelSpec("Random Forest", "balanced", lambda n: TreeParams(
            rounds=trees, max_leaves=1024, max_depth=10, min_rows=50, l2=0.0, min_hessian=0.0, forest=True,
            weight_scheme="balanced", seed=SEED)),
        ModelSpec("Boosted Trees", "positive", lambda n: TreeParams(
            rounds=boost_iter, max_leaves=32, max_depth=5, rate=0.05, rows=0.8, columns=0.8,
            positive_weight=BOOSTING_POSITIVE_WEIGHT, seed=SEED)),
    ]
    return models + ([second_booster_spec(boost_iter)] if second_booster else [])


def leafwise(rounds: int, leaves: int) -> TreeParams:
    """Boosting limited by leaves and not by depth: balanced weights, 20 rows a leaf, no penalty, started at the mean."""
    return TreeParams(rounds=rounds, max_leaves=leaves, max_depth=leaves, rate=0.05, rows=0.8, columns=0.8, l2=0.0, min_hessian=1e-3,
                      min_rows=20, start_at_mean=True, weight_scheme="balanced", seed=SEED)


def second_booster_spec(boost_iter: int = 300) -> ModelSpec:
    return ModelSpec("Boosted Trees (63 leaves)", "balanced", lambda n: leafwise(boost_iter, 63))


def assemble(df: DataFrame, features: Sequence[str], target: str, keep: Sequence[str] = ()) -> DataFrame:
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return va.transform(df.select(*[quote(k) for k in keep],
                                  *[F.col(quote(f)).cast("double").alias(f) for f in features],
                                  F.col(quote(target)).cast("double").alias("label")))


def prepare_split(train: DataFrame, test: DataFrame, features: Sequence[str],
                  target: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Both sides as (id, features, label) tables, written once so that every
    model of a split shares them.  Remaining missing feature values get the
    training medians first (B20)."""
    imputer = MedianImputer.fit(train, list(features))
    imputer.medians = {k: (v if v is not None else 0.0) for k, v in imputer.medians.items()}
    return tuple(
        write_checkpoint_table(assemble(imputer.transform(side), features, target, [id_col])
                               .select(quote(id_col), "features", "label"), name)
        for side, name in ((train, "fit_rows"), (test, "score_rows")))


def fit_score(spec: ModelSpec, train: DataFrame, test: DataFrame, id_col: str):
    """Fit on a prepared ``train``; return (model, scored test rows (id, y, score))."""
    model = spec.build(train.count()).fit(with_weights(train, "label", spec.weight_scheme))
    scored = model.transform(test).select(
        quote(id_col), F.col("label").cast("int").alias("y"),
        vector_to_array("probability")[1].alias("score"))
    return model, scored


def fit_splits(specs: Sequence[ModelSpec], splits: Sequence[tuple[int, DataFrame, DataFrame]], features: Sequence[str],
               target: str, id_col: str, cv_models: Sequence[str] | None = None,
               parallelism: int = 4) -> tuple[dict, DataFrame]:
    """Fit every model on every (fold, train, test) split.

    ``HELD_OUT`` marks the held-out split, whose models are returned by name;
    the folds are fitted for ``cv_models`` only (all by default).  All scored
    rows (model, fold, id, y, score) are written to one table.  Up to
    ``parallelism`` fits run side by side, as in MLlib's CrossValidator.
    """
    def wanted(fold):
        return [m for m in specs if fold == HELD_OUT or cv_models is None or m.name in cv_models]

    def prepare(split):
        fold, train, test = split
        return fold, *prepare_split(train, test, features, target, id_col)

    def fit(task):
        spec, fold, train, test = task
        model, scored = fit_score(spec, train, test, id_col)
        return spec.name, fold, model, scored.select(F.lit(spec.name).alias("model"), F.lit(fold).alias("fold"), "*")

    spark = splits[0][1].sparkSession
    with ThreadPool(max(1, parallelism)) as pool:
        ready = pool.map(inheritable_thread_target(spark)(prepare), [s for s in splits if wanted(s[0])])
        done = pool.map(inheritable_thread_target(spark)(fit),
                        [(m, *split) for split in ready for m in wanted(split[0])], chunksize=1)
    scored = write_checkpoint_table(reduce(DataFrame.unionByName, (d[3] for d in done)), "scores")
    return {name: model for name, fold, model, _ in done if fold == HELD_OUT}, scored


def fit_folds(specs: Sequence[ModelSpec], table: RowBlocks, cv_models: Sequence[str] | None = None,
              parallelism: int = 4) -> tuple[dict, DataFrame]:
    """Fit every model of row blocks on all its folds side by side.

    As :func:`fit_splits`: the held-out split's models by name, and all scored
    rows (model, fold, id, y, score) in one table.
    """
    def fit(spec):
        fits = [k for k in table.fits if k == HELD_OUT or cv_models is None or spec.name in cv_models]
        models = spec.build(0).fit_all(table, fits)
        return spec.name, models.get(HELD_OUT), score_blocks(table, models).select(F.lit(spec.name).alias("model"), "*")

    table.counts()
    with ThreadPool(max(1, parallelism)) as pool:
        done = pool.map(inheritable_thread_target(table.rows.sparkSession)(fit), specs, chunksize=1)
    return {name: m for name, m, _ in done}, write_checkpoint_table(reduce(DataFrame.unionByName, (d[2] for d in done)), "scores")


def evaluate(scored: DataFrame, groups: int) -> DataFrame:
    """(model, fold, roc_auc, average_precision, precision, recall, f1) for every
    model and fold of the scored rows; ``groups`` bounds their number."""
    long = scored.select(F.struct("model", "fold").alias("model"), "score", "y")
    rk = curves.ranking_metrics(long, groups_hint=groups)
    cm = curves.confusion_metrics(long, 0.5)
    return rk.join(cm, "model").select("model.*", "roc_auc", "average_precision", "precision", "recall", "f1")


def feature_importance(model, features: Sequence[str], name: str, spark) -> DataFrame:
    """(model, feature, importance, position) from a tree model (K11, J10): gains, normalised to sum 1."""
    imp = model.importances() if hasattr(model, "importances") else model.featureImportances.toArray()
    rows = [(name, f, float(imp[i]), i) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "model string, feature string, importance double, position int")


def tree_importance(df: DataFrame, features: Sequence[str], target: str, iterations: int = 200,
                    id_col: str | None = None) -> dict[str, float]:
    """Importance ranking for feature selection (J10): boosted trees with the
    reference's selection settings (200 rounds of up to 31 leaves, step 0.05,
    row and column samples of 0.8, balanced class weights) on the kept columns
    with missing values as 0.  Pass as ``importance_model`` to
    :meth:`riskframe.plans.featurize.FeaturePlan.fit` (top-k, ties by position).
    Row samples depend on ``id_col``, or on the features where it is not given."""
    filled = df.na.fill(0.0, subset=list(features)).withColumn("_fold", F.lit(0))
    if id_col is None:
        filled, id_col = filled.withColumn("_id", F.xxhash64(*[quote(f) for f in features])), "_id"
    table = row_blocks(filled, features, target, id_col, "_fold", [HELD_OUT])
    imp = leafwise(iterations, 31).fit_all(table)[HELD_OUT].importances()
    return {f: float(imp[i]) for i, f in enumerate(features)}
