"""Session construction and lineage cutting.

On a cluster the shared checkpoint folder comes from ``spark.checkpoint.dir``;
only a local session (tests, laptops) gets a private temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "riskframe",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session when it is set.

    A private temporary folder is created only for a local master; a cluster
    session without ``spark.checkpoint.dir`` is an error, because a
    machine-local folder is not visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def write_checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage between stages: a lost executor re-reads the table instead of
    recomputing every upstream shuffle.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def expire_tables(spark: SparkSession, hours: float = 24.0) -> int:
    """Delete stage tables and models below the checkpoint folder that nothing has changed for ``hours``; returns how many.

    Results are lazy, so only their user knows when their tables are done with:
    run this between jobs, with a span longer than the longest of them.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    oldest, gone = spark._jvm.java.lang.System.currentTimeMillis() - int(hours * 3_600_000), 0
    for folder, prefix in ((f"{base}/tables", ""), (base, "lm-")):
        if fs.exists(path(folder)):
            for status in fs.listStatus(path(folder)):
                if status.isDirectory() and status.getPath().getName().startswith(prefix) and status.getModificationTime() < oldest:
                    gone += bool(fs.delete(status.getPath(), True))
    return gone
