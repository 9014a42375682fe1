"""Second-order histogram trees: boosting (K4, K5, J10) and forests (K3).

Features are cut at quantiles into at most 255 bins of one byte (bin 0 is for
missing values).  A tree grows best-first: each leaf's best split comes from
sums of gradient, Hessian and rows per (feature, bin), and the leaf with the
largest gain is split next, up to ``max_leaves`` and ``max_depth``.  Leaves
that will be wanted next are looked at together, which gives the same tree as
one at a time in about as many passes as the tree is deep.

All folds and the held-out split grow side by side.  A pass over the blocks
sums the histograms of every wanted leaf of every fit inside each task; a
reducer for each (fit, tree, leaf) adds them up and returns its best split
only, so the driver sees one row per leaf.  Boosted margins are written with
the blocks every ``MARGIN_ROUNDS`` rounds, between which the newest trees are
applied on the fly.  Histograms are summed for the columns a leaf may split on
only.  A table whose bins fit a task (``BESIDE_BYTES``, or ``BESIDE_BLOCKS``
blocks of ``blocks.BLOCK_ROWS`` rows) needs no sums across tasks: each fit then
grows in a task that holds them, its rows in order of their leaves, and of two
large sibling leaves it sums the smaller one and subtracts.

Row samples and column samples come from hashes of the row's key and of the
round, so a lost task draws the same ones again.
"""

from __future__ import annotations

import heapq
from collections.abc import Generator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import blocks as B
from riskframe.session import write_checkpoint_table

MAX_BINS, MARGIN_ROUNDS = 255, 5
#: Leaves whose histograms one pass sums (of all columns; more of fewer ones), and forest trees that grow side by side.
LEAVES_A_PASS, TREES_A_PASS = 64, 16
#: Up to this many blocks (131,072 rows) or bytes of bins each fit grows in one task, which holds them twice beside some numbers a row
#: (a worker took 254 MB for 900,000 rows of 34 columns).  Beyond, a pass of Spark stages is paid for each step of growth.
BESIDE_BLOCKS, BESIDE_BYTES = 8, 64 << 20
#: Rows of a leaf above which its histograms are summed column by column; bins of several columns together that are summed as one column's.
COLUMN_ROWS, BUNDLE_BINS = 4096, 1024


@dataclass(frozen=True)
class TreeParams:
    """``forest``: trees are averages of the label on bootstrap rows, with a new column sample at every leaf."""

    rounds: int = 300
    max_leaves: int = 32
    max_depth: int = 5
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    l2: float = 1.0
    min_hessian: float = 1.0
    min_rows: int = 0
    start_at_mean: bool = False
    forest: bool = False
    weight_scheme: str = "positive"
    positive_weight: float = 11.0
    seed: int = 42

    def getMaxIter(self) -> int:
        return self.rounds

    def fit_all(self, table: B.RowBlocks, fits: Sequence[int] | None = None) -> dict[int, "Ensemble"]:
        return fit_trees(table, self, table.fits if fits is None else fits)


@dataclass
class Tree:
    """Nodes in order of creation; ``left`` is -1 at a leaf; rows go left where their bin is at most ``cut``."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, v in ((self.feature, 0), (self.cut, 0), (self.left, -1), (self.right, -1), (self.value, value), (self.gain, 0.0)):
            column.append(v)
        return len(self.left) - 1

    def leaves(self, codes: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each row of bins; ``at``: the nodes that the rows have reached so far."""
        feature, cut, left, right = (np.array(c, np.int64) for c in (self.feature, self.cut, self.left, self.right))
        at = np.zeros(len(codes), np.int64) if at is None else at.copy()
        moving = np.flatnonzero(left[at] >= 0)
        while len(moving):
            node = at[moving]
            at[moving] = np.where(codes[moving, feature[node]] <= cut[node], left[node], right[node])
            moving = moving[left[at[moving]] >= 0]
        return at

    def values(self, codes: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(codes)]


@dataclass
class Ensemble:
    features: tuple[str, ...]
    cuts: list[np.ndarray]
    trees: list[Tree]
    base: float
    params: TreeParams

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.score_codes(to_codes(x, self.cuts))

    def score_codes(self, codes: np.ndarray) -> np.ndarray:
        total = np.zeros(len(codes))
        for t in self.trees:
            total += t.values(codes)
        if self.params.forest:
            return total / max(len(self.trees), 1)
        return 1.0 / (1.0 + np.exp(-(self.base + self.params.rate * total)))

    def importances(self) -> np.ndarray:
        """Gain of each feature's splits, in shares of the whole."""
        out = np.zeros(len(self.features))
        for t in self.trees:
            split = np.array(t.left) >= 0
            np.add.at(out, np.array(t.feature, np.int64)[split], np.array(t.gain)[split])
        return out / out.sum() if out.sum() else out


# ---------------------------------------------------------------- bins

def to_codes(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of a matrix: 0 for a missing value, else 1 + the number of cuts below the value."""
    codes = np.empty(x.shape, np.uint8)
    for f, c in enumerate(cuts):
        codes[:, f] = np.where(np.isnan(x[:, f]), 0, np.searchsorted(c, x[:, f], side="left") + 1)
    return codes


def _bin(batches, cuts):
    for b in B.each_block(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([b[c].tobytes()], pa.binary()) for c in ("keys", "y", "fold")] + [pa.array([to_codes(b["x"], cuts).tobytes()], pa.binary())],
            names=["keys", "y", "fold", "codes"])


# ---------------------------------------------------------------- splits

def histograms(codes: np.ndarray, slot: np.ndarray, columns: np.ndarray, g: np.ndarray, h: np.ndarray,
               by_column: np.ndarray | None = None) -> np.ndarray:
    """Sums of (gradient, Hessian, rows) per (slot, column, bin) of each slot's ``columns``; rows with a negative slot take no part.

    ``by_column``: the transposed bins, where they are held in that order too.
    """
    by_column = codes.T if by_column is None else by_column
    slots, width = columns.shape
    out = np.zeros((slots, 3, width, MAX_BINS))
    base = np.arange(width, dtype=np.int64) * MAX_BINS
    order = np.argsort(slot, kind="stable")
    starts = np.searchsorted(slot[order], np.arange(slots + 1))
    for s in range(slots):
        at = order[starts[s]:starts[s + 1]]
        if len(at) > COLUMN_ROWS:
            drawn_g, drawn_h = g[at], h[at]
            for i, f in enumerate(columns[s]):
                key = by_column[f][at].astype(np.int64)
                out[s, 0, i] = np.bincount(key, drawn_g, minlength=MAX_BINS)
                out[s, 1, i] = np.bincount(key, drawn_h, minlength=MAX_BINS)
                out[s, 2, i] = np.bincount(key, minlength=MAX_BINS)
        elif len(at):
            key = (codes[at[:, None], columns[s]] + base).ravel()
            flat = out[s].reshape(3, -1)
            flat[0] = np.bincount(key, np.repeat(g[at], width), minlength=width * MAX_BINS)
            flat[1] = np.bincount(key, np.repeat(h[at], width), minlength=width * MAX_BINS)
            flat[2] = np.bincount(key, minlength=width * MAX_BINS)
    return out


def best_splits(hist: np.ndarray, columns: np.ndarray, p: TreeParams) -> list[tuple]:
    """Per slot: (gain, feature, cut, left g, left h, right g, right h, rows); gain 0 where no split is allowed."""
    left = np.cumsum(hist[..., :-1], axis=-1)
    whole = hist.sum(-1, keepdims=True)
    right = whole - left
    gl, hl, nl = left[:, 0], left[:, 1], left[:, 2]
    gr, hr, nr = right[:, 0], right[:, 1], right[:, 2]
    fine = (nl > 0) & (nr > 0) & (nl >= p.min_rows) & (nr >= p.min_rows) & (hl >= p.min_hessian) & (hr >= p.min_hessian)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl * gl / (hl + p.l2) + gr * gr / (hr + p.l2) - (whole[:, 0] ** 2 / (whole[:, 1] + p.l2))
    # Rounded, so that cuts of equal gain come by feature and bin whatever the order of the sums.
    gain = np.where(fine & (gain > 1e-9), gain, 0.0).astype(np.float32).reshape(len(hist), -1)
    at = gain.argmax(1)
    out = []
    for s, i in enumerate(at.tolist()):
        f, c = divmod(i, MAX_BINS - 1)
        out.append((float(gain[s, i]), int(columns[s, f]), c, *(float(m[s, f, c]) for m in (gl, hl, gr, hr)), float(whole[s, 2, 0, 0])))
    return out


def _mixed(*parts: int) -> int:
    """A 64-bit hash of whole numbers."""
    h = 0x9E3779B97F4A7C15
    for v in parts:
        h = ((h ^ (v & (2 ** 64 - 1))) * 0xBF58476D1CE4E5B9) % 2 ** 64
        h = ((h ^ (h >> 29)) * 0x94D049BB133111EB) % 2 ** 64
        h ^= h >> 32
    return h


def _uniform(keys: np.ndarray, seed: int) -> np.ndarray:
    """Per row a number in [0, 1) from its key and a seed."""
    h = keys.view(np.uint64) ^ np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def allowed_columns(p: TreeParams, width: int, tree: int, place: int) -> np.ndarray:
    """The columns a leaf may split on: one sample per tree, in a forest one of sqrt(width) per leaf (by its place in the tree)."""
    rng = np.random.default_rng(_mixed(p.seed, tree, place if p.forest else 0))
    out = np.zeros(width, bool)
    out[rng.permutation(width)[:_columns_a_leaf(p, width)]] = True
    return out


def _columns_a_leaf(p: TreeParams, width: int) -> int:
    return max(1, round(width ** 0.5 if p.forest else p.columns * width))


def _columns(p: TreeParams, width: int, tree: int, places: Sequence[int]) -> np.ndarray:
    """The numbers of the allowed columns of each leaf, rising."""
    return np.stack([np.flatnonzero(allowed_columns(p, width, tree, i)) for i in places])


def gradients(p: TreeParams, tree: int, y: np.ndarray, weight: np.ndarray, keys: np.ndarray, margin: np.ndarray | None):
    """(g, h) of each row for tree number ``tree``; both are 0 for rows that are not drawn."""
    u = _uniform(keys, _mixed(p.seed, tree, -1))
    if p.forest:  # bootstrap: how often a row is drawn follows Poisson(1)
        drawn = np.searchsorted(np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 18)])), u, side="right")
        return -weight * drawn * y, weight * drawn
    prob = 1.0 / (1.0 + np.exp(-margin))
    drawn = weight * (u < p.rows)
    return drawn * (prob - y), drawn * prob * (1 - prob)


def grow(p: TreeParams) -> Generator:
    """Best-first growth as a coroutine: yields (tree so far, node numbers, their places) and is sent each node's best split.

    The tree so far routes rows to the asked nodes; it may hold nodes that the
    finished tree, the coroutine's return value, does not.
    """
    seen, known = Tree(), {}
    seen.add(0.0)
    depth, place = {0: 0}, {0: 1}
    known.update((yield seen, [0], [1]))
    while True:
        # Replay the best-first order as far as the splits are known.
        leaves, kept, heap = 1, set(), [(-known[0][0], place[0], 0)]
        wanted = []
        while heap and leaves < p.max_leaves:
            gain, _, node = heapq.heappop(heap)
            if not gain:
                break
            if seen.left[node] < 0:
                wanted = [node] + [n for g, _, n in heapq.nsmallest(p.max_leaves - leaves - 1, heap) if g and seen.left[n] < 0]
                break
            kept.add(node)
            leaves += 1
            for child in (seen.left[node], seen.right[node]):
                heapq.heappush(heap, (-known[child][0], place[child], child))
        if not wanted:
            break
        made = []
        for node in wanted:
            gain, f, c, gl, hl, gr, hr, _ = known[node]
            seen.feature[node], seen.cut[node], seen.gain[node] = f, c, gain
            seen.left[node], seen.right[node] = seen.add(_value(p, gl, hl)), seen.add(_value(p, gr, hr))
            for side, child in enumerate((seen.left[node], seen.right[node])):
                depth[child], place[child] = depth[node] + 1, 2 * place[node] + side
                made.append(child)
        asked = [n for n in made if depth[n] < p.max_depth]
        for n in made:
            known[n] = (0.0,)
        if asked:
            known.update((yield seen, asked, [place[n] for n in asked]))
    return _kept(seen, kept)


def _value(p: TreeParams, g: float, h: float) -> float:
    return -g / (h + p.l2) if h + p.l2 > 0 else 0.0


def _kept(seen: Tree, kept: set[int]) -> Tree:
    out, number = Tree(), {}
    todo = [0]
    for node in todo:
        number[node] = out.add(seen.value[node])
        if node in kept:
            todo += [seen.left[node], seen.right[node]]
    for node in kept:
        i = number[node]
        out.feature[i], out.cut[i], out.gain[i] = seen.feature[node], seen.cut[node], seen.gain[node]
        out.left[i], out.right[i] = number[seen.left[node]], number[seen.right[node]]
    return out


def _slots(tree: Tree, nodes: list[int], leaves: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The number among ``nodes`` of each row's node in the tree so far; -1 elsewhere and for rows not drawn."""
    number = np.full(len(tree.left), -1)
    number[nodes] = np.arange(len(nodes))
    return np.where((h > 0) | (g != 0), number[leaves], -1)


# ---------------------------------------------------------------- fits

def fit_trees(table: B.RowBlocks, p: TreeParams, fits: Sequence[int], spread: bool | None = None) -> dict[int, Ensemble]:
    """One ensemble per fit.  ``spread``: sum over the blocks of many tasks (by default where one task cannot hold the bins)."""
    cuts = table.cuts(MAX_BINS)
    counts = table.counts()
    classes = {k: B.class_weights(counts[k], p.weight_scheme, p.positive_weight) for k in fits}
    base = dict.fromkeys(fits, 0.0)
    if p.start_at_mean:
        for k in fits:
            zero, one = (c * w for c, w in zip(counts[k], classes[k]))
            base[k] = float(np.log(one / zero)) if zero and one else 0.0
    coded = write_checkpoint_table(table.blocks.select("keys", "y", "fold", "x").mapInArrow(
        partial(_bin, cuts=cuts), "keys binary, y binary, fold binary, codes binary"), "binned")
    if spread is None:
        size = coded.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum(F.length("fold")), F.lit(0)).alias("folds")).first()
        spread = size.blocks > BESIDE_BLOCKS and size.folds // np.dtype(np.int32).itemsize * len(cuts) > BESIDE_BYTES
    trees = (_fit_spread if spread else _fit_beside)(coded, len(cuts), p, list(fits), classes, base)
    return {k: Ensemble(table.features, cuts, trees[k], base[k], p) for k in fits}


def _weights(b: dict, fit: int, classes: dict[int, tuple[float, float]]) -> np.ndarray:
    return np.where(B.learns(b["fold"], fit), np.where(b["y"] > 0, classes[fit][1], classes[fit][0]), 0.0)


def _pack_tree(t: Tree) -> bytes:
    """The six columns of a tree as doubles, which hold its whole numbers exactly."""
    return np.array([t.feature, t.cut, t.left, t.right, t.value, t.gain], np.float64).tobytes()


def _unpack_tree(packed: bytes) -> Tree:
    m = np.frombuffer(packed, np.float64).reshape(6, -1)
    return Tree(*(m[:4].astype(np.int64).tolist()), *(m[4:].tolist()))


def _fit_beside(coded: DataFrame, width: int, p: TreeParams, fits: list[int], classes, base) -> dict[int, list[Tree]]:
    """The table is a few blocks: each fit (of a forest, each run of its trees) grows in a task of its own."""
    step = max(p.rounds, 1)
    if p.forest:    # about four tasks a core, so that the last of them end together
        step = max(TREES_A_PASS, -(-p.rounds * len(fits) // (4 * coded.sparkSession.sparkContext.defaultParallelism)))
    jobs = [(k, t, min(t + step, p.rounds)) for k in fits for t in range(0, p.rounds, step)]
    dealt = coded.withColumn("job", F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.lit(k).alias("fit"), F.lit(s).alias("first"),
                                                                F.lit(e).alias("stop")) for i, (k, s, e) in enumerate(jobs)])))
    dealt = dealt.withColumn("at", F.col("job.at")).repartitionById(len(jobs), "at")
    found = dealt.select("keys", "y", "fold", "codes", "job.fit", "job.first", "job.stop").mapInArrow(
        partial(_grow_blocks, p=p, classes=classes, base=base), "fit int, tree int, nodes binary").collect()  # bounded by rounds x leaves
    trees = {k: [] for k in fits}
    for r in sorted(found, key=lambda r: (r.fit, r.tree)):
        trees[r.fit].append(_unpack_tree(r.nodes))
    return trees


def _grow_blocks(batches, p: TreeParams, classes, base):
    jobs: dict[tuple, list[dict]] = {}
    for b in B.each_block(batches):
        fit, first, stop = (b.pop(c)[0].as_py() for c in ("fit", "first", "stop"))
        at = np.flatnonzero(B.learns(b["fold"], fit))
        jobs.setdefault((fit, first, stop), []).append(
            {"codes": b["codes"][at], "y": b["y"][at], "keys": b["keys"][at], "weight": _weights(b, fit, classes)[at]})
    for (fit, first, stop), held in jobs.items():
        held.sort(key=lambda b: b["keys"].tobytes())    # the same order of rows in every run
        codes, y, keys, weight = (np.concatenate([b[c] for b in held]) for c in ("codes", "y", "keys", "weight"))
        held.clear()
        bins = _Bins(codes)
        margin = np.full(len(codes), base[fit])
        for t in range(first, stop):
            g, h = gradients(p, t, y, weight, keys, margin)
            tree = _grow_here(p, t, bins, g, h, None if p.forest else margin)
            yield pa.RecordBatch.from_arrays([pa.array([fit], pa.int32()), pa.array([t], pa.int32()), pa.array([_pack_tree(tree)], pa.binary())],
                                             names=["fit", "tree", "nodes"])


class _Bins:
    """Bins of the rows that a task holds, row by row, column by column, and in bundles.

    A bundle is the joint bin of several columns that have few bins together:
    sums per joint bin are added up to those of each of its columns.
    """

    def __init__(self, codes: np.ndarray):
        self.codes, self.by_column = codes, np.ascontiguousarray(codes.T)
        counts = (codes.max(0).astype(int) + 1) if len(codes) else np.ones(codes.shape[1], int)
        self.bundles, now, size = [], [], 1
        for f in sorted(np.flatnonzero(counts <= BUNDLE_BINS // 2).tolist(), key=lambda f: (counts[f], f)):
            if now and size * counts[f] > BUNDLE_BINS:
                self._close(now, counts)
                now, size = [], 1
            now.append(f)
            size *= counts[f]
        self._close(now, counts)

    def _close(self, columns: list[int], counts: np.ndarray) -> None:
        if len(columns) < 2:
            return
        joint, size, parts = np.zeros(len(self.codes), np.uint16), 1, []
        for f in columns:
            joint += self.by_column[f] * np.uint16(size)
            parts.append((f, size, int(counts[f])))
            size *= int(counts[f])
        # For each column the 0/1 matrix from joint bins to its own.
        self.bundles.append((joint, size, {f: np.eye(n)[np.arange(size) // step % n] for f, step, n in parts}))

    def sums(self, at: np.ndarray, columns: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Sums of (gradient, Hessian, rows) per (column, bin) over the rows ``at``."""
        width = len(columns)
        g, h = g[at], h[at]
        if len(at) <= COLUMN_ROWS:
            key = (self.codes[at[:, None], columns] + np.arange(width, dtype=np.int64) * MAX_BINS).ravel()
            return np.stack(_counted(key, np.repeat(g, width), np.repeat(h, width), width * MAX_BINS)).reshape(3, width, MAX_BINS)
        out = np.zeros((3, width, MAX_BINS))
        place = {f: i for i, f in enumerate(columns.tolist())}
        for joint, size, members in self.bundles:
            if len(asked := [f for f in members if f in place]) > 1:
                found = np.stack(_counted(joint[at].astype(np.int64), g, h, size))
                for f in asked:
                    out[:, place.pop(f), :members[f].shape[1]] = found @ members[f]
        for f, i in place.items():
            out[:, i] = _counted(self.by_column[f][at].astype(np.int64), g, h, MAX_BINS)
        return out


def _counted(key: np.ndarray, g: np.ndarray, h: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    return np.bincount(key, g, minlength=size), np.bincount(key, h, minlength=size), np.bincount(key, minlength=size)


def _grow_here(p: TreeParams, number: int, bins: _Bins, g: np.ndarray, h: np.ndarray, margin: np.ndarray | None = None) -> Tree:
    """One tree over rows that this task holds; its values times the rate are added to ``margin``."""
    drawn = (h > 0) | (g != 0)
    # Drawn rows, and for the margins the others, in order of their nodes: a node's rows stand between its two marks.
    orders = [np.flatnonzero(drawn)] + ([] if margin is None else [np.flatnonzero(~drawn)])
    marks = {0: [(0, len(o)) for o in orders]}
    divided: set[int] = set()
    sums: dict[int, np.ndarray] = {}

    def divide():
        for n in range(len(seen.left)):
            if seen.left[n] >= 0 and n not in divided:
                divided.add(n)
                column, cut = bins.by_column[seen.feature[n]], seen.cut[n]
                children = seen.left[n], seen.right[n]
                for child in children:
                    marks[child] = []
                for order, (start, end) in zip(orders, marks[n]):
                    at = order[start:end]
                    left = column[at] <= cut
                    middle = start + int(np.count_nonzero(left))
                    order[start:middle], order[middle:end] = at.compress(left), at.compress(~left)
                    marks[children[0]].append((start, middle))
                    marks[children[1]].append((middle, end))

    def summed(n, columns):
        start, end = marks[n][0]
        return bins.sums(orders[0][start:end], columns, g, h)

    growing = grow(p)
    seen, nodes, places = next(growing)
    while True:
        divide()
        columns = _columns(p, bins.codes.shape[1], number, places)
        hist = np.empty((len(nodes), 3, columns.shape[1], MAX_BINS))
        above = {child: n for n in sums if seen.left[n] >= 0 for child in (seen.left[n], seen.right[n])}
        place = {n: i for i, n in enumerate(nodes)}
        for i, n in enumerate(nodes):
            if n not in above:
                hist[i] = summed(n, columns[i])
        for n in {above[n] for n in nodes if n in above}:
            few, many = sorted((seen.left[n], seen.right[n]), key=lambda c: marks[c][0][1] - marks[c][0][0])
            hist[place[few]] = summed(few, columns[place[few]])
            # Rows are whole numbers; a bin without rows gets exact zeros, so that cuts on its two sides gain the same.
            hist[place[many]] = np.where((rest := sums.pop(n) - hist[place[few]])[2] > 0, rest, 0.0)
        if not p.forest:    # all leaves of a tree have the same columns
            sums.update((n, hist[i].copy()) for i, n in enumerate(nodes) if marks[n][0][1] - marks[n][0][0] > COLUMN_ROWS)
        found = [split for s in range(0, len(nodes), 32) for split in best_splits(hist[s:s + 32], columns[s:s + 32], p)]
        try:
            seen, nodes, places = growing.send(dict(zip(nodes, found)))
        except StopIteration as end:
            tree = end.value
            break
    if margin is not None:
        divide()
        todo = [(0, 0)]
        for node, old in todo:
            if tree.left[node] >= 0:
                todo += [(tree.left[node], seen.left[old]), (tree.right[node], seen.right[old])]
            else:
                for order, (start, end) in zip(orders, marks[old]):
                    margin[order[start:end]] += p.rate * tree.value[node]
    return tree


@dataclass(frozen=True)
class _Unit:
    """A tree that grows: what a task needs to route rows to the asked nodes."""

    fit: int
    number: int
    tree: Tree
    nodes: list[int]
    places: list[int]


def _fit_spread(coded: DataFrame, width: int, p: TreeParams, fits: list[int], classes, base) -> dict[int, list[Tree]]:
    """The histograms of all growing trees are summed over many tasks, pass by pass."""
    trees = {k: [] for k in fits}
    if p.forest:
        todo = [(k, t) for t in range(p.rounds) for k in fits]
        for s in range(0, len(todo), TREES_A_PASS):
            for (k, _), tree in zip(todo[s:s + TREES_A_PASS], _grow_spread(coded, width, p, todo[s:s + TREES_A_PASS], classes, None)):
                trees[k].append(tree)
        return trees
    coded = write_checkpoint_table(coded.mapInArrow(partial(_advance, fits=fits, base=base, rate=0.0, pending={}), _MARGINS), "margins")
    pending = {k: [] for k in fits}
    for t in range(p.rounds):
        for k, tree in zip(fits, _grow_spread(coded, width, p, [(k, t) for k in fits], classes, (fits, pending))):
            trees[k].append(tree)
            pending[k].append(tree)
        if (t + 1) % MARGIN_ROUNDS == 0 and t + 1 < p.rounds:
            coded = write_checkpoint_table(coded.mapInArrow(
                partial(_advance, fits=fits, base=base, rate=p.rate, pending=pending), _MARGINS), "margins")
            pending = {k: [] for k in fits}
    return trees


_MARGINS = "keys binary, y binary, fold binary, codes binary, margins binary"


def _margins(b: dict, fits: list[int], rate: float, pending: dict[int, list[Tree]]) -> np.ndarray:
    margins = b["margins"].reshape(len(fits), -1).copy()
    for i, k in enumerate(fits):
        for tree in pending[k]:
            margins[i] += rate * tree.values(b["codes"])
    return margins


def _advance(batches, fits, base, rate, pending):
    """Blocks with the margins of all fits; ``pending`` trees are added to those that are there."""
    for b in B.each_block(batches):
        if "margins" in b:
            margins = _margins(b, fits, rate, pending)
        else:
            margins = np.repeat(np.array([base[k] for k in fits])[:, None], len(b["y"]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (b["keys"], b["y"], b["fold"], b["codes"], margins)],
                                         names=["keys", "y", "fold", "codes", "margins"])


def _grow_spread(coded: DataFrame, width: int, p: TreeParams, units: list[tuple[int, int]], classes, boosted) -> list[Tree]:
    """The trees of ``units`` (fit, number), grown side by side: one pass over the blocks for each step of growth."""
    growing = [grow(p) for _ in units]
    asked = {i: next(c) for i, c in enumerate(growing)}
    done: list[Tree | None] = [None] * len(units)
    room = LEAVES_A_PASS * width // _columns_a_leaf(p, width)
    while asked:
        found: dict[int, dict[int, tuple]] = {i: {} for i in asked}
        wanted = [(i, n, place) for i, (_, nodes, places) in asked.items() for n, place in zip(nodes, places)]
        for s in range(0, len(wanted), room):
            part = wanted[s:s + room]
            jobs = {i: _Unit(*units[i], asked[i][0], [n for j, n, _ in part if j == i], [o for j, _, o in part if j == i])
                    for i in sorted({i for i, _, _ in part})}
            places = {(i, n): place for i, n, place in part}
            sums = coded.mapInArrow(partial(_sum_histograms, p=p, jobs=jobs, classes=classes, boosted=boosted),
                                    "unit int, node int, sums binary")
            reducers = min(len(part), coded.sparkSession.sparkContext.defaultParallelism)
            best = sums.repartition(reducers, "unit", "node").sortWithinPartitions("unit", "node").mapInArrow(
                partial(_settle, p=p, width=width, numbers={i: u.number for i, u in jobs.items()}, places=places),
                "unit int, node int, split array<double>").collect()  # one row per asked leaf
            for r in best:
                found[r.unit][r.node] = (r.split[0], int(r.split[1]), int(r.split[2]), *r.split[3:])
        still = {}
        for i in asked:
            # A leaf that no drawn row reaches has no sums and no split.
            reply = {n: found[i].get(n, (0.0,)) for n in asked[i][1]}
            try:
                still[i] = growing[i].send(reply)
            except StopIteration as end:
                done[i] = end.value
        asked = still
    return done


def _sum_histograms(batches, p: TreeParams, jobs: dict[int, _Unit], classes, boosted):
    total: dict[tuple[int, int], np.ndarray] = {}
    for b in B.each_block(batches):
        margins = _margins(b, boosted[0], p.rate, boosted[1]) if boosted else None
        by_column = np.ascontiguousarray(b["codes"].T)
        for i, unit in jobs.items():
            g, h = gradients(p, unit.number, b["y"], _weights(b, unit.fit, classes), b["keys"],
                             None if margins is None else margins[boosted[0].index(unit.fit)])
            columns = _columns(p, b["codes"].shape[1], unit.number, unit.places)
            slot = _slots(unit.tree, unit.nodes, unit.tree.leaves(b["codes"]), g, h)
            hist = histograms(b["codes"], slot, columns, g, h, by_column)
            for n, sums in zip(unit.nodes, hist):
                total[i, n] = total[i, n] + sums if (i, n) in total else sums
    for (i, n), sums in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([n], pa.int32()), pa.array([sums.tobytes()], pa.binary())],
                                         names=["unit", "node", "sums"])


def _settle(batches, p: TreeParams, width: int, numbers: dict[int, int], places: dict[tuple[int, int], int]):
    for (i, n), sums in B.add_up(batches, ["unit", "node"], "sums"):
        columns = _columns(p, width, numbers[i], [places[i, n]])
        split = best_splits(sums.reshape(1, 3, -1, MAX_BINS), columns, p)[0]
        yield pa.RecordBatch.from_pylist([{"unit": i, "node": n, "split": [float(v) for v in split]}], schema=pa.schema(
            [("unit", pa.int32()), ("node", pa.int32()), ("split", pa.list_(pa.float64()))]))
