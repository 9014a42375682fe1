"""Row blocks: the matrix form of a training table, and sums over it.

A block is one Parquet row that holds up to ``BLOCK_ROWS`` rows of a table as
packed columns, so that iterative fits scan numpy matrices instead of
converting rows again in every pass.  ``fold`` is the fold of a training row
and ``HELD_OUT`` for a held-out one; fit ``k`` learns from all training rows
outside fold ``k``, and fit ``HELD_OUT`` from all training rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.names import quote
from riskframe.session import write_checkpoint_table

#: The fold number of the held-out split.
HELD_OUT = -1
#: Rows of a block: 16,384 rows of 500 features are 64 MB.
BLOCK_ROWS = 16_384


def pack_rows(df: DataFrame, features: Sequence[str], target: str, id_col: str, fold: str,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks (ids, keys, y, fold, x) of ``df``, written once; ``x`` is rows x features, missing values NaN.

    Rows are dealt by id to ceil(count / ``block_rows``) partitions and sorted,
    so that the same table gives the same blocks in every run.
    """
    rows = df.count()
    features = list(features)
    kind = df.schema[id_col].dataType.simpleString()
    flat = df.select(F.col(quote(id_col)).alias("id"), F.xxhash64(quote(id_col)).alias("key"), F.col(quote(target)).cast("double").alias("y"),
                     F.col(quote(fold)).cast("int").alias("fold"),
                     F.array(*[F.col(quote(f)).cast("double") for f in features]).alias("x"))
    dealt = flat.repartition(max(1, -(-rows // block_rows)), "key").sortWithinPartitions("key", "id", "fold")
    return write_checkpoint_table(dealt.mapInArrow(
        partial(_pack, width=len(features), rows=block_rows), f"ids array<{kind}>, keys binary, y binary, fold binary, x binary"), "row-blocks")


def _pack(batches, width: int, rows: int):
    held, n = [], 0

    def settle(table):
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
        ids = table.column("id").combine_chunks()
        column = lambda c, t: pa.array([table.column(c).to_numpy().astype(t).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), column("key", np.int64), column("y", np.float64),
             column("fold", np.int32), pa.array([x.tobytes()], pa.binary())], names=["ids", "keys", "y", "fold", "x"])

    for b in batches:
        if len(b):
            held.append(b)
            n += len(b)
        while n >= rows:
            whole = pa.Table.from_batches(held)
            yield settle(whole.slice(0, rows))
            held, n = whole.slice(rows).to_batches(), n - rows
    if n:
        yield settle(pa.Table.from_batches(held))


def each_block(batches):
    """Blocks of Arrow batches as dictionaries of numpy columns; Arrow columns keep their name with ``_column``."""
    kinds = {"keys": np.int64, "y": np.float64, "fold": np.int32, "x": np.float64, "codes": np.uint8, "margins": np.float64}
    for b in batches:
        for i in range(len(b)):
            block = {}
            for name in b.schema.names:
                value = b.column(b.schema.get_field_index(name))
                if name in kinds:
                    block[name] = np.frombuffer(value[i].as_py(), kinds[name])
                else:
                    block[name] = value.slice(i, 1)
            n = len(block["y"])
            for name in ("x", "codes"):
                if name in block:
                    block[name] = block[name].reshape(n, -1)
            yield block


def learns(fold: np.ndarray, fit: int) -> np.ndarray:
    """The rows that fit ``fit`` learns from."""
    return (fold != HELD_OUT) & (fold != fit)


def scored_by(fold: np.ndarray, fit: int) -> np.ndarray:
    """The rows that fit ``fit`` is judged on."""
    return fold == fit


@dataclass
class RowBlocks:
    """A training table as row blocks, with what its fits share."""

    rows: DataFrame           # one row per table row: id, target, fold and features
    blocks: DataFrame
    features: tuple[str, ...]
    fold: str
    fits: tuple[int, ...]
    _counts: dict[int, tuple[int, int]] | None = None
    _cuts: dict[int, list[np.ndarray]] = field(default_factory=dict)
    _once: Lock = field(default_factory=Lock, repr=False)     # models that are fitted side by side wait for the same cuts

    def counts(self) -> dict[int, tuple[int, int]]:
        """(rows of class 0, rows of class 1) that each fit learns from; counted once."""
        if self._counts is None:
            seen = self.blocks.select("y", "fold").mapInArrow(_count, "fold int, y int, n long").groupBy("fold", "y").agg(
                F.sum("n").alias("n")).collect()
            self._counts = {k: tuple(sum(r.n for r in seen if r.y == c and r.fold not in (HELD_OUT, k)) for c in (0, 1))
                            for k in self.fits}
        return self._counts

    def cuts(self, bins: int) -> list[np.ndarray]:
        """At most ``bins`` - 2 rising cut values per feature: approximate quantiles of the training rows, values that occur."""
        with self._once:
            if bins not in self._cuts:
                train = self.rows.where(F.col(quote(self.fold)) != HELD_OUT)
                probs, found = [(i + 1) / (bins - 1) for i in range(bins - 2)], []
                for s in range(0, len(self.features), 50):  # wide aggregates in pieces that still compile
                    values = [F.col(quote(f)).cast("double") for f in self.features[s:s + 50]]
                    row = train.agg(*[F.percentile_approx(F.when(~F.isnan(v), v), probs, 20 * bins).alias(f"c{i}")
                                      for i, v in enumerate(values)]).first()
                    found += [np.unique(np.array(c or [], np.float64) + 0.0) for c in row]
                self._cuts[bins] = found
            return self._cuts[bins]


def row_blocks(df: DataFrame, features: Sequence[str], target: str, id_col: str, fold: str, fits: Sequence[int],
               block_rows: int = BLOCK_ROWS) -> RowBlocks:
    return RowBlocks(df, pack_rows(df, features, target, id_col, fold, block_rows), tuple(features), fold, tuple(fits))


def _count(batches):
    for b in each_block(batches):
        pairs, n = np.unique(np.stack([b["fold"], b["y"].astype(np.int32)], 1), axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int32()), pa.array(pairs[:, 1], pa.int32()), pa.array(n, pa.int64())],
                                         names=["fold", "y", "n"])


def class_weights(counts: tuple[int, int], scheme: str, positive: float = 1.0) -> tuple[float, float]:
    """Weights of class 0 and 1: 'balanced' n / (2 n_class), else (1, ``positive``)."""
    if scheme != "balanced":
        return 1.0, positive
    n = sum(counts)
    return tuple(n / (2.0 * c) if c else 0.0 for c in counts)


def summed(df: DataFrame, keys: Sequence[str], payload: str, tasks: int) -> DataFrame:
    """Rows (keys, payload) of equal-length float64 vectors, added up key by key.

    Each task's rows are already sums over its blocks; a reducer adds its keys'
    rows one at a time, so it holds one vector.
    """
    keys = list(keys)
    dealt = df.repartition(max(1, tasks), *keys).sortWithinPartitions(*keys)
    kinds = dict(df.dtypes)
    return dealt.mapInArrow(partial(_sum, keys=keys, payload=payload), ", ".join(f"{k} {kinds[k]}" for k in keys) + f", {payload} binary")


def add_up(batches, keys, payload):
    """(key, summed vector) of each run of equal keys."""
    now, total = None, None
    for b in batches:
        named = list(zip(*(b.column(b.schema.get_field_index(k)).to_pylist() for k in keys)))
        column = b.column(b.schema.get_field_index(payload))
        for i, key in enumerate(named):
            part = np.frombuffer(column[i].as_py(), np.float64)
            if key != now:
                if now is not None:
                    yield now, total
                now, total = key, part.copy()
            else:
                total += part
    if now is not None:
        yield now, total


def _sum(batches, keys, payload):
    for key, total in add_up(batches, keys, payload):
        yield pa.RecordBatch.from_pylist([{**dict(zip(keys, key)), payload: total.tobytes()}],
                                         schema=pa.schema([(k, pa.int32()) for k in keys] + [(payload, pa.binary())]))
