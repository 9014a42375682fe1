"""Quality classifier: a sparse ensemble of conjunctive rules (operator 10).

Text statistics are column expressions.  Boosted and bagged trees of depth
three, fitted on labelled rows, give candidate rules: every path prefix is a
conjunction of thresholds on statistics.  Logistic regression with a lasso
penalty weighs the rules and drops most of them, and the rest compile into one
Spark column expression, so scoring is a projection of the statistics without
a model object.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.quality_rules import SPACES, words_of
from riskframe.session import write_checkpoint_table

#: At most this many labelled rows, the smallest hashes first, are used to fit.
MAX_TRAIN_ROWS = 20_000
TREES, DEPTH, LASSO, SEED = 12, 3, 0.002, 42
ACCEPT = 0.7
STATS = ("log_words", "mean_word", "symbol", "upper", "pipe", "exclaim", "digit", "distinct", "alone", "end_mark", "line_words")


def with_stats(docs: DataFrame) -> DataFrame:
    """Add the statistics that rules test to (doc_id, text, ...); NULL texts count as empty."""
    body = F.coalesce("text", F.lit(""))
    bare = F.translate(body, SPACES, "")
    count = lambda pattern: F.length(F.regexp_replace(bare, pattern, ""))
    lines = F.length(body) - F.length(F.translate(body, "\n", "")) + 1
    staged = docs.withColumn("_words", words_of(F.col("text"))).withColumn("_chars", F.greatest(F.length(bare), F.lit(1)))
    words = F.greatest(F.size("_words"), F.lit(1))
    own = lambda chars: (F.col("_chars") - F.length(F.translate(bare, chars, ""))) / F.col("_chars")
    some = F.when(bare == "", 0.0)
    return staged.select(
        *docs.columns, F.log1p(F.size("_words")).alias("log_words"), (F.length(bare) / words).alias("mean_word"),
        some.otherwise(own("#$%&*")).alias("symbol"), some.otherwise(count(r"\P{Lu}+") / F.col("_chars")).alias("upper"),
        some.otherwise(own("|")).alias("pipe"), some.otherwise(own("!")).alias("exclaim"),
        some.otherwise(own("0123456789")).alias("digit"),
        (F.size(F.array_distinct("_words")) / F.sqrt(words)).alias("distinct"),
        (F.size(F.array_distinct("_words")) / words).alias("alone"),
        some.otherwise(own(".,")).alias("end_mark"), (words / lines).alias("line_words"))


@dataclass(frozen=True)
class Rules:
    """Weighted conjunctions: score = logistic(bias + sum of the weights of the rules that hold)."""

    bias: float
    rules: tuple[tuple[float, tuple[tuple[str, str, float], ...]], ...]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for weight, terms in self.rules:
            total = total + F.when(_holds(terms), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def _holds(terms) -> Column:
    made = F.lit(True)
    for name, op, cut in terms:
        made = made & (F.col(name) <= cut if op == "<=" else F.col(name) > cut)
    return made


def tree_paths(tree, names) -> set[tuple[tuple[str, str, float], ...]]:
    """Every path prefix of a fitted tree as a sorted conjunction, bounds on the same side merged."""
    found, path = set(), []
    for line in tree.toDebugString.splitlines():
        m = re.match(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        path = [p for p in path if p[0] < len(m[1])]
        path.append((len(m[1]), names[int(m[2])], m[3], float(m[4])))
        terms: dict[tuple[str, str], float] = {}
        for _, name, op, cut in path:
            old = terms.get((name, op), cut)
            terms[name, op] = min(old, cut) if op == "<=" else max(old, cut)
        found.add(tuple(sorted((name, op, cut) for (name, op), cut in terms.items())))
    return found


def fit(train: DataFrame, label: str = "label") -> Rules:
    """Fit on a bounded table of statistics and a 0/1 ``label``; a one-valued label gives a constant score."""
    mean, rows = train.agg(F.avg(label), F.count("*")).first()
    if not rows or mean in (0.0, 1.0):
        return Rules(0.0 if not rows else (8.0 if mean else -8.0), ())
    data = VectorAssembler(inputCols=list(STATS), outputCol="x").transform(train).select("x", F.col(label).cast("double").alias("y"), *STATS).cache()
    kwargs = {"featuresCol": "x", "labelCol": "y", "maxDepth": DEPTH, "seed": SEED}
    trees = [*GBTClassifier(maxIter=TREES, stepSize=0.3, subsamplingRate=0.8, **kwargs).fit(data).trees,
             *RandomForestClassifier(numTrees=TREES, **kwargs).fit(data).trees]
    rules = sorted(set().union(*(tree_paths(t, STATS) for t in trees)))
    flags = data.select("y", *(F.when(_holds(r), 1.0).otherwise(0.0).alias(f"r{i}") for i, r in enumerate(rules)))
    flags = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="r").transform(flags).select("y", "r")
    model = LogisticRegression(featuresCol="r", labelCol="y", regParam=LASSO, elasticNetParam=1.0, maxIter=60,
                               standardization=False).fit(flags)
    data.unpersist()
    return Rules(float(model.intercept), tuple(
        (float(w), r) for w, r in zip(model.coefficients.toArray(), rules) if w))


def held_out_rows() -> Column:
    """crc32 of the id's text modulo 4 is 2; a NULL id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit_rules(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> Rules:
    """Fit on the labelled documents outside the held-out fold, at most ``max_train_rows`` (smallest id hashes)."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("quality").alias("label"))
    chosen = (docs.select("doc_id").filter(~held_out_rows()).join(known, "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_train_rows))
    chosen = write_checkpoint_table(chosen.distinct(), "train-ids")
    # At most max_train_rows ids and labels: small enough to meet the texts without shuffling them.
    train = with_stats(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")).drop("text")
    # Subsampling depends on partitions and row order, so one sorted file of these few rows gives every run the same rules.
    train = train.select(*STATS, "label").repartition(1).sortWithinPartitions(*STATS, "label")
    return fit(write_checkpoint_table(train, "train"))


def score_quality(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and the statistics.

    Labels of held-out ids are never read.  Only doc_id and text of ``docs``
    and doc_id and quality of ``labels`` are read, so other columns may have
    any name.  NULL ids, NULL labels and labels without a document take no
    part in the fit; NULL texts score as empty ones; repeated rows get equal
    scores; an empty table gives an empty result, no labels a score of 0.5.
    """
    score = fit_rules(docs, labels, max_train_rows).score()
    stats = with_stats(docs.select("doc_id", "text")).withColumn("held_out", held_out_rows())
    return stats.select("doc_id", "held_out", score.alias("score"),
                        F.when(score >= ACCEPT, 1).otherwise(0).alias("predicted"), *STATS)
