"""Corpus pipeline: quality, near-duplicates, decontamination, personal data, packing.

``run(spark, sf_dir)`` reads ``documents`` and applies the stages in order;
each stage's rows are written as Parquet to the shared folder and read again
as the next stage's documents.  Every stage but the last returns the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import decontaminate, near_dedup, packing, pii, quality_classifier
from riskframe.session import ensure_checkpoint_dir, write_checkpoint_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality classifier accepts (a score of 0.7 at least).

    Every row is judged by its own text: NULL texts as empty ones, rows with a
    NULL id like any other, repeated rows alike.  Without labels to learn from,
    all documents stay; an empty table stays empty.
    """
    stats = quality_classifier.with_stats(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality_classifier.fit_rules(docs, labels)
    if rules.bias == 0 and not rules.rules:
        return docs
    # Filters don't move below observed metrics, so each statistic is computed once and not once for every rule term.
    scored = stats.select("row", rules.score().alias("score")).observe("quality_scored", F.count(F.lit(1)).alias("rows"))
    return scored.filter(F.col("score") >= quality_classifier.ACCEPT).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each near-duplicate component and all rows without an id.

    Whole rows that repeat stay once where they have an id.  Texts without
    words are nobody's duplicate; an id with several texts goes or stays with
    all of them; an empty table stays empty.
    """
    found = near_dedup.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    kept = docs.join(found, "doc_id", "left_anti").select(docs.columns)
    known = kept.filter("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return known.unionByName(kept.filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage.

    An id with several texts goes where one of them holds a passage; rows
    without an id, NULL and empty texts stay; with an empty benchmark, or an
    empty table, nothing changes.
    """
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in every text and update ``n_chars``; no row goes.

    NULL texts stay NULL (``n_chars`` too), texts without personal data stay as
    they are, repeated rows change alike; an empty table stays empty.
    """
    return pii.redact(docs).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token chunks in length buckets and token-budget batches.

    Every token of every row is in one chunk; NULL and empty texts, rows
    without an id and ties in length are packed as :func:`packing.pack` says;
    an empty table gives an empty result.
    """
    return packing.pack(docs)


STAGES = [("quality_classifier", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", packed)]

#: The stages are not expressible in SQL; tests/llm holds each one, and the whole run, against small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_checkpoint_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
