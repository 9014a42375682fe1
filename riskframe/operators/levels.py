"""Levels of text columns up to a limit.

Decisions need to know whether a column has at most two or ten levels, and
which.  Each task keeps a set per column that gives up at ``limit`` + 1, so an
id-like column costs one row a task, not a shuffle of its values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.names import quote
from riskframe.session import write_checkpoint_table


def bounded_levels(df: DataFrame, cols: Sequence[str], limit: int, missing_as: str | None = None) -> dict[str, list[str] | None]:
    """Sorted levels of each column, or None where there are more than ``limit``.

    NULL counts as the level ``missing_as``; without it, NULL is no level.
    """
    cols = list(cols)
    if not cols:
        return {}
    text = df.select(*[F.coalesce(F.col(quote(c)).cast("string"), F.lit(missing_as)).alias(f"c{i}") for i, c in enumerate(cols)])
    found = text.mapInArrow(partial(_levels, limit=limit), "column int, level string")
    # A task sends at most ``limit`` levels a column, or one NULL where it saw more.
    levels = write_checkpoint_table(found.distinct(), "levels")
    small = levels.groupBy("column").agg(F.count("level").alias("n"), F.count(F.lit(1)).alias("rows")).cache()
    out: dict[str, list[str] | None] = {c: [] for c in cols}
    for r in small.where((F.col("n") > limit) | (F.col("n") < F.col("rows"))).collect():
        out[cols[r.column]] = None
    kept = small.where((F.col("n") <= limit) & (F.col("n") == F.col("rows")))
    for r in levels.join(kept.select("column"), "column", "left_semi").collect():     # at most ``limit`` a column
        out[cols[r.column]].append(r.level)
    small.unpersist()
    return {c: None if v is None else sorted(v) for c, v in out.items()}


def _levels(batches, limit: int):
    held: list[set | None] | None = None
    for b in batches:
        held = [set() for _ in b.schema.names] if held is None else held
        for i, own in enumerate(held):
            if own is not None:
                own.update(pc.unique(b.column(i).drop_null()).slice(0, limit + 1).to_pylist())
                if len(own) > limit:
                    held[i] = None
    for i, own in enumerate(held or []):
        levels = [None] if own is None else sorted(own)
        yield pa.RecordBatch.from_arrays([pa.array([i] * len(levels), pa.int32()), pa.array(levels, pa.string())], names=["column", "level"])
