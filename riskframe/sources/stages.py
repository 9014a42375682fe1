"""Stages with commit records: resume where a run was cut off.

``StageStore.run`` computes a stage only where no valid commit record stands
for the same inputs: each stage is written to a folder of its own run, and the
record -- fingerprint of the inputs, schema, rows, folder -- is put in place by
one rename after the table is complete.  A run that was killed leaves a folder
without a record, which no one reads and the next commit of the stage removes
together with superseded ones.  Log rows of a stage replace that stage's own
earlier rows, so a stage that runs twice logs once.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from riskframe.sources.results import LOG_SCHEMA


def fingerprint(spark: SparkSession, inputs: Sequence[DataFrame], params: dict | None = None) -> str:
    """Hash of the inputs' files (path, length, time of change), their schemas and the parameters.

    An input that reads no file counts by its plan's description.
    """
    parts = [json.dumps(params or {}, sort_keys=True, default=str)]
    for df in inputs:
        files = sorted(df.inputFiles())
        parts.append(df.schema.json())
        for f in files:
            where = spark._jvm.org.apache.hadoop.fs.Path(f)
            status = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where)
            parts.append(f"{f} {status.getLen()} {status.getModificationTime()}")
        if not files:
            parts.append(df._jdf.queryExecution().analyzed().canonicalized().toString())
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


class StageStore:
    """Stage tables below ``base``: ``stage/run-<id>`` folders and one commit record per stage."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ records
    def _read_text(self, path: str) -> str | None:
        where = self._path(path)
        if not self._fs.exists(where):
            return None
        stream = self._fs.open(where)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def record(self, stage: str) -> dict | None:
        """The commit record of a stage: fingerprint, schema, rows, folder, seconds; None where there is none."""
        text = self._read_text(f"{self.base}/{stage}/COMMITTED.json")
        return None if text is None else json.loads(text)

    def _commit(self, stage: str, record: dict) -> None:
        target = self._path(f"{self.base}/{stage}/COMMITTED.json")
        draft = self._path(f"{self.base}/{stage}/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(record).encode()))
        finally:
            out.close()
        self._fs.delete(target, False)
        if not self._fs.rename(draft, target):
            raise OSError(f"could not commit stage {stage}")

    def _expire(self, stage: str, keep: str) -> None:
        """Remove the folders of superseded and unfinished runs."""
        for status in self._fs.listStatus(self._path(f"{self.base}/{stage}")):
            name = status.getPath().getName()
            if (name.startswith("run-") and name != keep) or name.startswith(".draft-"):
                self._fs.delete(status.getPath(), True)

    # ------------------------------------------------------------ stages
    def read(self, stage: str, expected: str | None = None) -> DataFrame | None:
        """The stage's table where its record is valid: folder there, schema and (if given) fingerprint equal."""
        record = self.record(stage)
        if record is None or (expected is not None and record["fingerprint"] != expected):
            return None
        folder = self._path(f"{self.base}/{stage}/{record['folder']}/_SUCCESS")
        if not self._fs.exists(folder):
            return None
        df = self.spark.read.parquet(f"{self.base}/{stage}/{record['folder']}")
        return df if df.schema.simpleString() == record["schema"] else None

    def run(self, stage: str, inputs: Sequence[DataFrame], build: Callable[..., DataFrame], params: dict | None = None) -> DataFrame:
        """``build(*inputs)``'s table: read back where a record stands for these inputs, else computed, written and committed."""
        mark = fingerprint(self.spark, inputs, params)
        done = self.read(stage, mark)
        if done is not None:
            return done
        started, folder = time.time(), f"run-{uuid.uuid4().hex}"
        path = f"{self.base}/{stage}/{folder}"
        build(*inputs).write.mode("errorifexists").parquet(path)
        table = self.spark.read.parquet(path)
        self._commit(stage, {"fingerprint": mark, "schema": table.schema.simpleString(), "rows": table.count(), "folder": folder,
                             "seconds": round(time.time() - started, 3)})
        self._expire(stage, folder)
        return table

    def log(self, stage: str, rows: DataFrame) -> None:
        """Replace the stage's log rows (columns of the run log)."""
        path = f"{self.base}/log/stage={stage}"
        rows.drop("stage").write.mode("overwrite").parquet(path)

    def read_log(self) -> DataFrame:
        """All stages' log rows, one set per stage."""
        if not self._fs.exists(self._path(f"{self.base}/log")):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        columns = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
        return self.spark.read.option("basePath", f"{self.base}/log").schema(LOG_SCHEMA).parquet(f"{self.base}/log").select(columns)
