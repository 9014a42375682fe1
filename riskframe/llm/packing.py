"""Packing: optimal length buckets and token-budget batches (operator 2).

Texts become token sequences (words and one end mark), cut into chunks of at
most ``max_len`` tokens, so no token is lost.  The global histogram of chunk
lengths has at most ``max_len`` rows; dynamic programming over it chooses the
bucket boundaries with the least padding.  Inside a bucket, sequences are
numbered without gaps by counting per group of rows and adding the counts of
earlier groups; a batch is a run of ``budget // boundary`` numbers, so only the
last batch of a bucket is not full.  Groups have about the square root of
their bucket's rows: neither a group nor the list of groups meets one task in
proportion to the table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.quality_rules import words_of
from riskframe.session import write_checkpoint_table

MAX_LEN, BUCKETS, TOKEN_BUDGET = 2048, 12, 16_384


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds (ascending) of at most ``buckets`` buckets with the least total padding."""
    if not lengths:
        return []
    order = np.argsort(lengths)
    size, count = np.asarray(lengths, np.float64)[order], np.asarray(counts, np.float64)[order]
    n = len(size)
    many, mass = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(count * size)]
    # waste[i, j]: padding when lengths i..j-1 go to boundary size[j-1]
    best, back = np.r_[0, np.full(n, np.inf)], []
    for _ in range(min(buckets, n)):
        waste = best[:, None] + np.where(
            np.arange(n + 1)[:, None] < np.arange(n + 1)[None, :],
            np.r_[0, size][None, :] * (many[None, :] - many[:, None]) - (mass[None, :] - mass[:, None]), np.inf)
        back.append(np.argmin(waste, axis=0))
        best = np.min(waste, axis=0)
    cuts, j = [], n
    for step in reversed(back):
        if j <= 0:
            break
        cuts.append(int(size[j - 1]))
        j = int(step[j])
    return cuts[::-1]


def chunks(docs: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """(doc_id, chunk, first_token, n_tokens) of every text; NULL texts have the end mark only."""
    n = F.size(words_of(F.col("text"))) + 1
    return (docs.select("doc_id", n.alias("_n")).select("doc_id", "_n", F.explode(
        F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / max_len).cast("int"))).alias("chunk"))
        .select("doc_id", "chunk", (F.col("chunk") * max_len).cast("long").alias("first_token"),
                F.least(F.lit(max_len), F.col("_n") - F.col("chunk") * max_len).cast("long").alias("n_tokens")))


def pack(docs: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """Per chunk: doc_id, chunk, first_token, n_tokens, bucket, padded_len, batch, slot.

    ``batch`` counts from 0 inside a bucket and ``slot`` inside a batch; a
    batch holds at most ``budget`` tokens, padding included (one sequence at
    least).  Reads doc_id and text only, so other columns may have any name.
    Repeated rows and NULL ids are sequences of their own; an empty table
    gives an empty result.
    """
    rows = write_checkpoint_table(chunks(docs, max_len), "chunks")
    histogram = rows.groupBy("n_tokens").agg(F.count("*").alias("rows")).collect()  # at most max_len rows
    bounds = best_boundaries([r[0] for r in histogram], [r[1] for r in histogram], buckets) or [max_len]
    held = [sum(r[1] for r in histogram if lo < r[0] <= hi) for lo, hi in zip([0, *bounds], bounds)]
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("bucket") + 1)
    bucket = sum((F.when(F.col("n_tokens") > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    groups = [max(1, round(h ** 0.5)) for h in held]
    placed = (rows.withColumn("bucket", bucket).withColumn("padded_len", pick(bounds).cast("long"))
              .withColumn("_group", F.pmod(F.xxhash64("doc_id", "chunk", "n_tokens"), pick(groups))))
    sizes = placed.groupBy("bucket", "_group").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("bucket").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "_group", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("bucket", "_group").orderBy("doc_id", "chunk")
    number = F.col("_before") + F.row_number().over(inside) - 1
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("padded_len")))
    return (placed.join(offsets, ["bucket", "_group"]).withColumn("_number", number)
            .select("doc_id", "chunk", "first_token", "n_tokens", F.col("bucket").cast("int").alias("bucket"), "padded_len",
                    F.floor(F.col("_number") / room).cast("long").alias("batch"),
                    (F.col("_number") % room).cast("int").alias("slot")))
