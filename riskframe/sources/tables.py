"""CSV sources and sinks, optional support tables, stage tables.

Raw CSV is read as text (every column a string) and typed by content
afterwards (:func:`riskframe.operators.clean.coerce_numeric_like`): schema
inference on raw text is defeated by placeholder tokens such as ``NA``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from riskframe.functions.names import standardize_columns


def resolve_csv(spark: SparkSession, data_dir: str, name: str) -> str | None:
    """The direct path when it exists, else the lexicographically first file
    or folder named ``name`` anywhere below ``data_dir`` (the listing is a metadata call
    through Hadoop's file system, so it works on object stores too)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(data_dir)
    fs = base.getFileSystem(conf)
    direct = jvm.org.apache.hadoop.fs.Path(base, name)
    if fs.exists(direct):
        return direct.toString()
    found, pending = [], [base]
    while pending:                       # breadth-first walk over metadata only
        for st in fs.listStatus(pending.pop()):
            if st.getPath().getName() == name:
                found.append(st.getPath().toString())   # a file, or a folder of part files
            elif st.isDirectory():
                pending.append(st.getPath())
    return sorted(found)[0] if found else None


def read_csv_table(spark: SparkSession, data_dir: str, name: str,
                   required: bool = True) -> DataFrame | None:
    """Header CSV as text columns with standardized names (A1).  A missing
    optional table returns None (A6); a missing required one raises."""
    path = resolve_csv(spark, data_dir, name)
    if path is None:
        if required:
            raise FileNotFoundError(f"no CSV file or folder for table {name!r} in {data_dir!r}")
        return None
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("multiLine", False).option("escape", '"').csv(path))
    return standardize_columns(df)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV export (A2); one file per task, written in parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_stage(df: DataFrame, base: str, stage: str) -> DataFrame:
    """Persist a stage result as Parquet and return the re-read table (A7):
    the next stage starts from the file, and a later run can resume there."""
    path = os.path.join(base, stage) if "://" not in base else f"{base.rstrip('/')}/{stage}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_stage(spark: SparkSession, base: str, stage: str) -> DataFrame:
    """Resume from a previous stage's table; FileNotFoundError when it is absent (A7), any other error as it is."""
    path = os.path.join(base, stage) if "://" not in base else f"{base.rstrip('/')}/{stage}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        raise FileNotFoundError(f"stage table {stage} not found under {base}")
    return spark.read.parquet(path)
