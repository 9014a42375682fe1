"""Logistic regression of all folds and the held-out split side by side (K2, K6, K7).

Newton's method on 1/2 |w|^2 + C sum_i s_i log(1 + exp(-y_i m_i)) with an
unpenalised intercept.  A pass over the row blocks sums loss, gradient and
Hessian of every fit that has not converged, so five folds and the final fit
need as many passes as the slowest of them alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import blocks as B


@dataclass(frozen=True)
class LogisticFit:
    """Estimator: L2-penalised logistic regression with inverse strength ``c``."""

    c: float = 1.0
    max_iter: int = 1000
    tolerance: float = 1e-10
    weight_scheme: str = "balanced"
    positive_weight: float = 1.0

    def getMaxIter(self) -> int:
        return self.max_iter

    def fit_all(self, table: B.RowBlocks, fits: Sequence[int] | None = None) -> dict[int, "LogisticModel"]:
        found, passes = fit_logistic(table, self, table.fits if fits is None else fits)
        return {k: LogisticModel(table.features, w, passes) for k, w in found.items()}


@dataclass(frozen=True)
class LogisticModel:
    features: tuple[str, ...]
    weights: np.ndarray     # one per feature, then the intercept
    passes: int = 0

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(x @ self.weights[:-1] + self.weights[-1])


def _sigmoid(m: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(m))
    return np.where(m >= 0, 1.0 / (1.0 + e), e / (1.0 + e))


def _moments(batches, weights: dict[int, np.ndarray], classes: dict[int, tuple[float, float]]):
    """Per fit: loss, gradient, Hessian of the data part, summed over the task's blocks."""
    total = {k: np.zeros(1 + len(w) + len(w) ** 2) for k, w in weights.items()}
    for b in B.each_block(batches):
        x = np.hstack([b["x"], np.ones((len(b["y"]), 1))])
        for k, w in weights.items():
            at = B.learns(b["fold"], k)
            rows, y = x[at], b["y"][at]
            s = np.where(y > 0, classes[k][1], classes[k][0])
            m = rows @ w
            p = _sigmoid(m)
            out, d = total[k], len(w)
            out[0] += (s * (np.maximum(m, 0) - m * (y > 0) + np.log1p(np.exp(-np.abs(m))))).sum()
            out[1:1 + d] += rows.T @ (s * (p - y))
            out[1 + d:] += ((rows * (s * p * (1 - p))[:, None]).T @ rows).ravel()
    for k, v in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v.tobytes()], pa.binary())], names=["fit", "sums"])


def fit_logistic(table: B.RowBlocks, p: LogisticFit, fits: Sequence[int]) -> tuple[dict[int, np.ndarray], int]:
    """(weights of each fit, passes over the blocks)."""
    width = len(table.features)
    classes = {k: B.class_weights(table.counts()[k], p.weight_scheme, p.positive_weight) for k in fits}
    best = {k: np.zeros(width + 1) for k in fits}
    ridge = np.append(np.ones(width), 0.0) / p.c
    trial, loss, step, done, passes = dict(best), {}, {}, set(), 0
    while len(done) < len(fits) and passes < p.max_iter:
        asked = {k: trial[k] for k in fits if k not in done}
        rows = table.blocks.select("y", "fold", "x").mapInArrow(partial(_moments, weights=asked, classes=classes), "fit int, sums binary")
        passes += 1
        for r in B.summed(rows, ["fit"], "sums", len(asked)).collect():
            k, sums, d = r.fit, np.frombuffer(r.sums, np.float64), width + 1
            now = sums[0] + 0.5 * (ridge * trial[k] ** 2).sum()
            if k in loss and not now <= loss[k] + 1e-12 * abs(loss[k]):
                step[k] = step[k] / 2                       # too far: half the way
                trial[k] = best[k] + step[k]
                if np.abs(step[k]).max() < p.tolerance:
                    done.add(k)
                continue
            best[k], loss[k] = trial[k], now
            gradient = sums[1:1 + d] + ridge * best[k]
            hessian = sums[1 + d:].reshape(d, d) + np.diag(ridge)
            # A fold without one of the classes, or without rows, has no curvature along the intercept.
            step[k] = -np.linalg.lstsq(hessian, gradient, rcond=1e-14)[0]
            if np.abs(step[k]).max() <= p.tolerance * max(1.0, np.abs(best[k]).max()):
                done.add(k)
            trial[k] = best[k] + step[k]
    return best, passes


def score_blocks(table: B.RowBlocks, models: dict[int, object]) -> DataFrame:
    """(fold, id, y, score): every fit's probability for the rows it is judged on; models offer ``score(matrix)``."""
    blocks = table.blocks
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    return blocks.select("ids", "y", "fold", "x").mapInArrow(
        partial(_score, models=models), f"fold int, id {kind}, y int, score double")


def _score(batches, models):
    for b in B.each_block(batches):
        for k, model in models.items():
            at = np.flatnonzero(B.scored_by(b["fold"], k))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k, np.int32)), b["ids"].flatten().take(pa.array(at)),
                     pa.array(b["y"][at].astype(np.int32)), pa.array(model.score(b["x"][at]))], names=["fold", "id", "y", "score"])
