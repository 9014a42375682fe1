"""Content-driven cleaning.

Every data-dependent decision (which text column is numeric, which median
fills which column) is collected once as small driver metadata -- one value
per column -- and then applied by a single static projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.names import quote, standardize_columns
from riskframe.functions.numeric import non_finite_to_null, numeric_like, text_to_double
from riskframe.operators.longform import numeric_columns, string_columns
from riskframe.operators.quantiles import column_stats
from riskframe.spec import (
    DAYS_EMPLOYED_SENTINEL, NUMERIC_SHARE, PLACEHOLDER_TOKENS, TEXT_FILL, TableSpec,
)


def _trim_all(c):
    # pandas str.strip() removes all surrounding whitespace; F.trim only spaces
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_placeholders(df: DataFrame, cols: Sequence[str] | None = None,
                           tokens: Sequence[str] = PLACEHOLDER_TOKENS) -> DataFrame:
    """Trim text columns and turn placeholder tokens into NULL (B2)."""
    cols = set(string_columns(df) if cols is None else cols)
    out = []
    for c in df.columns:
        if c in cols:
            t = _trim_all(F.col(quote(c)))
            out.append(F.when(t.isin(list(tokens)), None).otherwise(t).alias(c))
        else:
            out.append(F.col(quote(c)))
    return df.select(*out)


def numeric_share(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, int]]:
    """(non-missing, parseable) counts for each text column, one aggregate job."""
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(quote(c)).alias(f"n{i}"),
                 F.count(F.when(numeric_like(quote(c)), 1)).alias(f"p{i}")]
    row = df.agg(*aggs).first()
    return {c: (int(row[f"n{i}"]), int(row[f"p{i}"])) for i, c in enumerate(cols)}


def coerce_numeric_like(df: DataFrame, cols: Sequence[str] | None = None,
                        share: float = NUMERIC_SHARE) -> tuple[DataFrame, list[str]]:
    """Text columns whose non-missing values parse as numbers at ``share`` or
    more become double; the unparseable rest becomes NULL (B4).  An all-missing
    column stays text."""
    cols = string_columns(df) if cols is None else list(cols)
    counts = numeric_share(df, cols)
    converted = [c for c, (n, p) in counts.items() if n > 0 and p / n >= share]
    conv = set(converted)
    out = [text_to_double(F.col(quote(c))).alias(c) if c in conv else F.col(quote(c))
           for c in df.columns]
    return df.select(*out), converted


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, int]:
    """Missing count per column in one aggregate."""
    cols = list(df.columns if cols is None else cols)
    if not cols:
        return {}
    row = df.agg(*[F.sum(F.col(quote(c)).isNull().cast("long")).alias(f"m{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: int(row[f"m{i}"] or 0) for i, c in enumerate(cols)}


def column_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact medians (mean of the middle two) of many columns, by bracket selection."""
    return {c: s.quantiles[0] for c, s in column_stats(df, cols, [0.5]).items()}


@dataclass
class MedianImputer:
    """Fill missing numeric values with the exact column median.

    ``fit`` takes the rows to learn from (training rows by default in the
    modelling plan); ``transform`` applies the frozen medians to any rows.
    """

    medians: dict[str, float | None] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "MedianImputer":
        return cls(column_medians(df, cols))

    def transform(self, df: DataFrame) -> DataFrame:
        fill = {c: m for c, m in self.medians.items() if m is not None}
        return df.select(*[F.coalesce(F.col(quote(c)), F.lit(float(fill[c]))).alias(c)
                           if c in fill else F.col(quote(c)) for c in df.columns])


def impute_median(df: DataFrame, cols: Sequence[str] | None = None,
                  exclude: Sequence[str] = (), fit_on: DataFrame | None = None
                  ) -> tuple[DataFrame, dict[str, float | None], dict[str, int]]:
    """(filled frame, medians, fills per column); an all-missing column keeps its
    NULLs and counts no fills."""
    cols = numeric_columns(df, exclude) if cols is None else list(cols)
    imputer = MedianImputer.fit(fit_on if fit_on is not None else df, cols)
    missing = null_counts(df, cols)
    fills = {c: (missing[c] if imputer.medians.get(c) is not None else 0) for c in cols}
    return imputer.transform(df), imputer.medians, fills


def impute_constant(df: DataFrame, cols: Sequence[str] | None = None,
                    value: str = TEXT_FILL) -> DataFrame:
    """Missing text -> a constant."""
    cols = string_columns(df) if cols is None else list(cols)
    return df.na.fill(value, subset=cols) if cols else df


def drop_exact_duplicates(df: DataFrame) -> tuple[DataFrame, int]:
    """Full-row duplicates removed (B3, G1); returns the number removed."""
    before = df.count()
    out = df.dropDuplicates()
    return out, before - out.count()


def non_finite_columns_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN/+-Inf -> NULL in numeric columns (B14); run once at ingest."""
    cols = set(numeric_columns(df) if cols is None else cols)
    return df.select(*[non_finite_to_null(F.col(quote(c))).alias(c)
                       if c in cols and dict(df.dtypes)[c] in ("double", "float")
                       else F.col(quote(c)) for c in df.columns])


def clean_table(df: DataFrame, name: str, spec: TableSpec | None = None,
                text_fill: str = TEXT_FILL, materialize: bool = True) -> tuple[DataFrame, dict]:
    """B1 -> B3 -> B2 -> B4 -> B5 -> B6, with the cleaning log.

    Passes over the data: one aggregate on the raw table (rows, missing
    cells); the de-duplicated, placeholder-normalised table is written once to
    the shared checkpoint folder (``materialize``); one aggregate on it (rows,
    missing per column, parseable share per text column); one exact-median
    pass.  Everything else is a static projection.

    The id and target are numeric but never imputed; dates, booleans and other
    types have no fill value and pass through.  ``missing_after`` counts every
    cell that is still missing, those included.  Missing text becomes
    ``text_fill`` (documented behaviour; pass ``"nan"`` to get the literal
    string the reference's published columns carry).
    """
    from riskframe.session import write_checkpoint_table
    spec = spec or TableSpec()
    df = non_finite_columns_to_null(standardize_columns(df))
    raw_cols = len(df.columns)
    first = df.agg(F.count(F.lit(1)).alias("_rows"),
                   *[F.sum(F.col(quote(c)).isNull().cast("long")).alias(f"m{i}")
                     for i, c in enumerate(df.columns)]).first()
    raw_rows = int(first["_rows"])
    raw_missing = sum(int(first[f"m{i}"] or 0) for i in range(raw_cols))
    texts = string_columns(df)
    dedup = normalize_placeholders(df.dropDuplicates(), texts)
    if materialize:
        dedup = write_checkpoint_table(dedup, f"clean_{name}")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(dedup.columns):
        aggs.append(F.sum(F.col(quote(c)).isNull().cast("long")).alias(f"m{i}"))
        if c in texts:
            aggs.append(F.count(F.when(numeric_like(quote(c)), 1)).alias(f"p{i}"))
    second = dedup.agg(*aggs).first()
    rows = int(second["_rows"])
    idx = {c: i for i, c in enumerate(dedup.columns)}
    missing = {c: int(second[f"m{idx[c]}"] or 0) for c in dedup.columns}
    converted = [c for c in texts
                 if rows - missing[c] > 0
                 and int(second[f"p{idx[c]}"]) / (rows - missing[c]) >= NUMERIC_SHARE]
    conv = set(converted)
    typed = dedup.select(*[text_to_double(F.col(quote(c))).alias(c) if c in conv else F.col(quote(c))
                           for c in dedup.columns])
    keep = [c for c in spec.passthrough if c in typed.columns]
    nums = numeric_columns(typed, keep)
    imputer = MedianImputer.fit(typed, nums)
    # after typing, a converted column is missing where it was missing or unparseable
    num_missing = {c: (rows - int(second[f"p{idx[c]}"]) if c in conv else missing[c]) for c in nums}
    num_fills = sum(n for c, n in num_missing.items() if imputer.medians.get(c) is not None)
    still_text = [c for c in texts if c not in conv]
    unfilled = {c: missing[c] for c in dedup.columns if c not in num_missing and c not in still_text}
    unfilled |= {c: rows - int(second[f"p{idx[c]}"]) for c in keep if c in conv}
    unfilled |= {c: n for c, n in num_missing.items() if imputer.medians.get(c) is None}
    out = impute_constant(imputer.transform(typed), still_text, text_fill)
    log = {
        "table": name,
        "raw_rows": raw_rows,
        "raw_cols": raw_cols,
        "clean_rows": rows,
        "clean_cols": len(out.columns),
        "duplicates_removed": raw_rows - rows,
        "missing_before": raw_missing,
        "numeric_imputed": num_fills,
        "categorical_imputed": sum(missing[c] for c in still_text),
        "missing_after": sum(unfilled.values()),
        "numeric_columns_converted": converted,
    }
    return out, log


def sentinel_flag(df: DataFrame, col: str, sentinel: float = DAYS_EMPLOYED_SENTINEL,
                  flag_col: str | None = None, median: float | None = None,
                  count: bool = True) -> tuple[DataFrame, int | None, float | None]:
    """Flag rows equal to ``sentinel`` (int8), set them missing, fill the column
    with the median of the remaining values (B9).  Returns (frame, hits, median);
    ``count=False`` skips the extra pass that counts the hits."""
    flag_col = flag_col or f"{col}_ANOM"
    hit = (F.col(quote(col)) == F.lit(sentinel))
    marked = df.withColumn(flag_col, F.coalesce(hit, F.lit(False)).cast("tinyint")) \
               .withColumn(col, F.when(~hit, F.col(quote(col))).cast("double"))
    n = df.where(hit).count() if count else None
    if median is None:
        median = column_medians(marked, [col])[col]
    if median is not None:
        marked = marked.withColumn(col, F.coalesce(F.col(quote(col)), F.lit(float(median))))
    return marked, n, median


def drop_constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Keep numeric columns with more than one distinct non-missing value (B19);
    min < max means the same for numbers and is one cheap aggregate."""
    cols = numeric_columns(df) if cols is None else list(cols)
    if not cols:
        return df, []
    row = df.agg(*[(F.min(quote(c)) < F.max(quote(c))).alias(f"k{i}")
                   for i, c in enumerate(cols)]).first()
    dropped = [c for i, c in enumerate(cols) if not row[f"k{i}"]]
    return df.drop(*dropped), dropped


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Last-resort 0 for numeric columns."""
    cols = numeric_columns(df) if cols is None else list(cols)
    return df.na.fill(0.0, subset=cols) if cols else df


def class_filter(df: DataFrame, target: str, value: int) -> DataFrame:
    """Rows of one class."""
    return df.where(F.col(quote(target)) == F.lit(value))
