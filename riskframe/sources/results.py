"""Run logs and results files (A3, A4, A5).

A run log is one long table ``(stage, table, metric, value)`` appended per
stage, so there is no nested document whose schema could drift.  Results JSON
in the reference's nested shape ``{model: {metric: value}}`` is read back
into the long form as maps of maps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "stage string, table string, metric string, value double, text string"
RESULTS_SCHEMA = "model string, stage string, metric string, value double"


def log_rows(spark: SparkSession, stage: str, table: str, log: dict) -> DataFrame:
    """A stage's log dictionary as rows; lists become their length plus a text."""
    rows = []
    for k, v in log.items():
        if isinstance(v, bool):
            rows.append((stage, table, k, float(v), None))
        elif isinstance(v, (int, float)):
            rows.append((stage, table, k, float(v), None))
        elif isinstance(v, (list, tuple)):
            rows.append((stage, table, k, float(len(v)), ",".join(map(str, v))))
        elif v is not None:
            rows.append((stage, table, k, None, str(v)))
    return spark.createDataFrame(rows, LOG_SCHEMA)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The run log; a path that does not exist is an empty table (A4), other errors are raised."""
    return spark.read.parquet(path) if _exists(spark, path) else spark.createDataFrame([], LOG_SCHEMA)


def read_results_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested results JSON ``{"test_results": {model: {metric: v}}, "cv_results": ...}``
    -> (model, stage, metric, value).  A missing file gives an empty table (A4)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], RESULTS_SCHEMA)
    sections = {"test_results": "test", "cv_results": "cv"}
    kind = ", ".join(f"{s} map<string,map<string,string>>" for s in sections)
    # Maps of maps: any number of models and metrics is the same plan; a metric that is no number is NULL.
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("j"))
    named = F.explode(F.array(*[F.struct(F.lit(stage).alias("stage"), F.col(f"j.{s}").alias("models")) for s, stage in sections.items()]))
    per_model = raw.select(named.alias("s")).select("s.stage", F.explode("s.models").alias("model", "metrics"))
    return per_model.select("model", "stage", F.explode("metrics").alias("metric", "text")).select(
        "model", "stage", "metric", F.col("text").try_cast("double").alias("value"))


def write_results(df: DataFrame, path: str) -> None:
    """Results long table as Parquet."""
    df.write.mode("overwrite").parquet(path)
