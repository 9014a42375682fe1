"""Column-name handling."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def standardize_name(name: str) -> str:
    """strip, upper case, and ' ', '/', '-' to '_'."""
    return re.sub(r"[ /-]", "_", name.strip().upper())


def quote(name: str) -> str:
    """Back-tick a column name so dots, commas and spaces resolve literally."""
    return "`" + name.replace("`", "``") + "`"


def unique_names(names: list[str]) -> list[str]:
    """Resolve collisions (Spark resolves names case-insensitively): the first
    keeps its name, later ones get ``_2``, ``_3`` ..."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        key = n.upper()
        if key in seen:
            seen[key] += 1
            candidate = f"{n}_{seen[key]}"
            while candidate.upper() in seen:
                seen[key] += 1
                candidate = f"{n}_{seen[key]}"
            seen[candidate.upper()] = 1
            out.append(candidate)
        else:
            seen[key] = 1
            out.append(n)
    return out


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`standardize_name` (metadata only, no data pass)."""
    return df.toDF(*unique_names([standardize_name(c) for c in df.columns]))


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of equally named columns (case-insensitive), B12."""
    keep, seen = [], set()
    for i, name in enumerate(df.columns):
        if name.upper() not in seen:
            seen.add(name.upper())
            keep.append(i)
    if len(keep) == len(df.columns):
        return df
    renamed = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
    return renamed.select(*[renamed[f"__c{i}"].alias(df.columns[i]) for i in keep])
