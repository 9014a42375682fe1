"""Score newly arriving rows with frozen, fitted state (A5 on a stream).

The reference saves its fitted scaler to reuse on new rows.  Here any fitted
transform -- a :class:`~riskframe.plans.featurize.FeaturePlan`, an imputer, a
scaler -- is a pure projection with literal constants, so it applies unchanged
to a Structured Streaming source: no state store, no shuffle, exactly-once
through the sink's checkpoint in the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskframe.session import ensure_checkpoint_dir


def read_new_rows(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A Parquet folder as a stream of newly arriving files."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def score_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                 sink_path: str | None = None, query_name: str = "riskframe_scores",
                 fmt: str = "parquet") -> StreamingQuery:
    """Apply ``transform`` to every micro-batch and append the result.

    ``fmt="memory"`` (tests) keeps results in a table named ``query_name``.
    The checkpoint lives under the session's shared checkpoint folder."""
    spark = stream.sparkSession
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"
    writer = transform(stream).writeStream.outputMode("append").option("checkpointLocation", ckpt)
    if fmt == "memory":
        return writer.format("memory").queryName(query_name).start()
    return writer.format(fmt).option("path", sink_path).start()
