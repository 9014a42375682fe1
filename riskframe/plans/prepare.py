"""Preparation stage (the reference's task 1): clean the main table and each
support table, roll every support table up to one row per id, left-join the
roll-ups to the main table, and log every step.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from riskframe.functions.names import drop_duplicate_columns
from riskframe.operators import clean, rollup
from riskframe.session import write_checkpoint_table
from riskframe.sources.results import log_rows
from riskframe.spec import TableSpec


def prepare(main: DataFrame, supports: Mapping[str, DataFrame | None],
            spec: TableSpec | None = None, text_fill: str = "UNKNOWN",
            materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """Returns (merged table, run log).  ``supports`` maps a prefix (e.g.
    ``BUREAU``) to its raw table; ``None`` marks an absent optional table,
    which is skipped (A6).  The main table must carry the id."""
    spec = spec or TableSpec()
    spark = main.sparkSession
    cleaned, log = clean.clean_table(main, "main", spec, text_fill)
    if spec.id_col not in cleaned.columns:
        raise ValueError(f"{spec.id_col} not in main table")
    logs = [log_rows(spark, "prepare", "main", log)]
    if materialize:
        cleaned = write_checkpoint_table(cleaned, "main_clean")
    rolled = []
    for prefix, table in supports.items():
        if table is None:
            logs.append(log_rows(spark, "prepare", prefix, {"skipped_missing_table": 1}))
            continue
        t, tlog = clean.clean_table(table, prefix, TableSpec(spec.id_col, spec.target_col), text_fill)
        r = rollup.rollup(t, spec.id_col, prefix)
        if materialize:
            r = write_checkpoint_table(r, f"rollup_{prefix}")
        tlog["rollup_rows"] = r.count()
        tlog["rollup_cols"] = len(r.columns)
        logs.append(log_rows(spark, "prepare", prefix, tlog))
        rolled.append(r)
    merged = drop_duplicate_columns(rollup.join_rollups(cleaned, rolled, spec.id_col))
    merged_log = {"merged_rows": merged.count(), "merged_cols": len(merged.columns)}
    logs.append(log_rows(spark, "prepare", "merged", merged_log))
    out_log = logs[0]
    for lg in logs[1:]:
        out_log = out_log.unionByName(lg)
    return merged, out_log
