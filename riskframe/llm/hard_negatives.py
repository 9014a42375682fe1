"""Hard negatives from Hilbert-ordered blocks with zone maps (operator 11).

1. Vectors become whole numbers.  Rows are dealt by their place on a Hilbert
   curve through the dimensions that vary most (ties by id, so that one vector
   held by a third of the rows still spreads), sorted, and packed: one Parquet
   row per block of ``BLOCK_ROWS`` candidates, with the smallest and largest
   value of each dimension and the labels that occur (the zone map).
2. The anchors of neighbouring blocks travel as one pack, each with the score
   of its fifth-best positive inside its block: a lower bound of the final one.
3. Zone maps, without the vectors, meet the packs in shards.  Interval
   arithmetic bounds every inner product of an anchor with a block's rows
   from both sides; a block is read by a pack only where some anchor's upper
   bound reaches its positives' bound and another row of its label is there.
4. With the positives known, the same bounds choose the blocks that each
   anchor's score windows must read for negatives.

Blocks are shuffled once for each of the two passes; packs travel to the
blocks that they must read.  A task holds one block, one pack and their
scores; an anchor's best rows are merged by aggregates of at most five rows a
part.  Scores are exact whole numbers: through doubles while every sum is
below 2^53, else through 64-bit integers, else through Python integers cut to
64 bits.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.session import write_checkpoint_table

SCALE, POSITIVES, NEGATIVES, LOW, HIGH, ANCHOR_EVERY = 256, 5, 5, 80, 100, 100
#: Candidates in a block, blocks whose anchors form a pack, and zone maps in a shard.
BLOCK_ROWS, PACK_BLOCKS, ZONE_SHARD = 1024, 64, 4096
#: The curve runs through this many dimensions with this many bits each (60 bits in all).
CURVE_DIMS, CURVE_BITS = 12, 5
_LIMIT = np.iinfo(np.int64).max


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows x dimensions, ``bits`` bits each), as int64.

    Coordinates become the curve's transposed index by undoing, from the
    highest bit down, the reflections and swaps of each sub-cube (Skilling's
    method), then a Gray code; interleaving their bits gives the place.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0]) ^ swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where(x[-1] & q, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T of int64 rows, cut to 64 bits."""
    top = lambda m: int(max(m.max(initial=0), -int(m.min(initial=0))))
    reach = top(a) * top(b) * max(a.shape[1], 1)
    if reach < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if reach <= _LIMIT:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -_LIMIT, _LIMIT).astype(np.int64)


def score_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any vector inside each box, as doubles rounded outwards."""
    a = anchors.astype(np.float64)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    lo, hi = low.T.astype(np.float64), high.T.astype(np.float64)
    least, most = up @ lo + down @ hi, up @ hi + down @ lo
    slack = 1e-9 * (np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)))
    return least - slack, most + slack


def _squeeze(q: np.ndarray) -> bytes:
    """A matrix in the narrowest of 2, 4 and 8 bytes a value."""
    top = max(int(q.max(initial=0)), -int(q.min(initial=0)) - 1)
    return q.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64).tobytes()


def _matrix(blob: bytes, rows: int, dims: int) -> np.ndarray:
    if not rows * dims:
        return np.zeros((rows, dims), np.int64)
    return np.frombuffer(blob, f"<i{len(blob) // (rows * dims)}").reshape(rows, dims).astype(np.int64)


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of long lists as a matrix; shorter vectors count as zero-padded."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), np.int64)
    out[np.repeat(np.arange(len(column)), sizes),
        np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def clean_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, q): rows with an id, a label and finite components; the whole row once where it repeats.

    ``q`` holds floor(scale * x), and ids divisible by 7 move to the next label of ten.
    """
    wide = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return wide.filter("vec_id is not null and label is not null and e is not null").filter(finite).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        # Beyond 64 bits a component stays at the end of the range.
        F.transform("e", lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-9e18)), F.lit(9e18))).cast("long")).alias("q"))


def _moments(batches):
    """One row per dimension and task: n, sum, sum of squares, least, greatest."""
    total = None
    for b in batches:
        if not len(b):
            continue
        column = b.column("q")
        m = _vectors(column, int(np.diff(column.offsets.to_numpy()).max())).astype(np.float64)
        part = np.stack([np.full(m.shape[1], len(m), np.float64), m.sum(0), (m * m).sum(0), m.min(0), m.max(0)], 1)
        if total is None:
            total = part
        else:
            a, b2 = (total, part) if len(total) >= len(part) else (part, total)
            a[:len(b2), :3] += b2[:, :3]
            a[:len(b2), 3] = np.minimum(a[:len(b2), 3], b2[:, 3])
            a[:len(b2), 4] = np.maximum(a[:len(b2), 4], b2[:, 4])
            total = a
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)))] + [pa.array(total[:, i]) for i in range(5)],
                                         names=["dim", "n", "s", "ss", "lo", "hi"])


def _place(batches, dims: int, chosen: list[int], low: np.ndarray, cell: np.ndarray, bits: int):
    for b in batches:
        if len(b):
            at = (_vectors(b.column("q"), dims)[:, chosen] - low) / cell
            place = hilbert_index(np.clip(at, 0, (1 << bits) - 1).astype(np.int64), bits)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), b.column("q"), pa.array(place)],
                                             names=["vec_id", "label", "q", "place"])


_BLOCK = ("block long, pack long, low array<long>, high array<long>, labels array<long>, counts array<long>, ids array<long>, "
          "row_labels array<long>, vectors binary, anchor_ids array<long>, anchor_labels array<long>, anchor_vectors binary, "
          "floors array<long>")
_SCHEMA = pa.schema([(c, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.list_(pa.int64())))
                     for c, t in (f.split() for f in _BLOCK.split(", "))])


def _blocks(batches, dims: int, rows: int, every: int, positives: int):
    """Sorted rows of a range become block rows; a block's anchors are packed beside it."""
    part, made, held, n = TaskContext.get().partitionId(), 0, [], 0

    def settle(table):
        q = _vectors(table.column("q").combine_chunks(), dims)
        ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        kinds, counts = np.unique(labels, return_counts=True)
        chosen = np.flatnonzero(ids % every == 0)
        # The last wanted positive inside the block is a lower bound of the anchor's final one.
        scores = inner_products(q[chosen], q)
        same = (labels[chosen][:, None] == labels) & (ids[chosen][:, None] != ids)
        floors = np.full(len(chosen), -_LIMIT)
        for i in np.flatnonzero(same.sum(1) >= positives):
            found = scores[i][same[i]]
            floors[i] = np.partition(found, len(found) - positives)[len(found) - positives]
        return pa.RecordBatch.from_pylist([{
            "block": (part << 32) + made, "pack": (part << 32) + made // PACK_BLOCKS, "low": q.min(0).tolist(), "high": q.max(0).tolist(),
            "labels": kinds.tolist(), "counts": counts.tolist(), "ids": ids.tolist(), "row_labels": labels.tolist(),
            "vectors": _squeeze(q), "anchor_ids": ids[chosen].tolist(), "anchor_labels": labels[chosen].tolist(),
            "anchor_vectors": _squeeze(q[chosen]), "floors": floors.tolist()}], schema=_SCHEMA)

    for b in batches:
        if len(b):
            held.append(b)
            n += len(b)
        while n >= rows:
            whole = pa.Table.from_batches(held)
            yield settle(whole.slice(0, rows))
            held, n, made = whole.slice(rows).to_batches(), n - rows, made + 1
    if n:
        yield settle(pa.Table.from_batches(held))


def build_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS, every: int = ANCHOR_EVERY, positives: int = POSITIVES):
    """(table of Hilbert-ordered blocks, dimensions) of :func:`clean_vectors` rows."""
    rows = write_checkpoint_table(rows, "vectors")
    # One row per dimension.
    per_dim = rows.select("q").mapInArrow(_moments, "dim long, n double, s double, ss double, lo double, hi double").groupBy(
        "dim").agg(*(F.sum(c).alias(c) for c in ("n", "s", "ss")), F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("dim").collect()
    dims = len(per_dim)
    if not dims:
        placed = rows.withColumn("place", F.lit(0).cast("long"))
    else:
        spread = [r.ss / r.n - (r.s / r.n) ** 2 for r in per_dim]
        chosen = sorted(range(dims), key=lambda i: (-spread[i], i))[:CURVE_DIMS]
        low = np.array([per_dim[i].lo for i in chosen])
        cell = np.maximum(np.array([per_dim[i].hi for i in chosen]) - low, 1) / (1 << CURVE_BITS)
        placed = rows.mapInArrow(partial(_place, dims=dims, chosen=chosen, low=low, cell=cell, bits=CURVE_BITS),
                                 "vec_id long, label long, q array<long>, place long")
    dealt = placed.repartitionByRange("place", "vec_id", "label").sortWithinPartitions("place", "vec_id", "label", "q")
    return write_checkpoint_table(dealt.mapInArrow(
        partial(_blocks, dims=dims, rows=block_rows, every=every, positives=positives), _BLOCK), "blocks"), dims


def _anchors(r: dict, dims: int):
    """(ids, labels, vectors, floors) of a pack's anchors, in the order of its blocks."""
    parts = r["anchors"]
    flat = lambda c: np.array([v for p in parts for v in p[c]], np.int64)
    return flat("anchor_ids"), flat("anchor_labels"), np.concatenate(
        [_matrix(p["anchor_vectors"], len(p["anchor_ids"]), dims) for p in parts]), flat("floors")


def _choose(batches, dims: int, windows: bool):
    """(pack, block) pairs that the zone maps cannot rule out; rows are a pack and a shard of zone maps."""
    for batch in batches:
        for r in batch.to_pylist():
            _, labels, vectors, floors = _anchors(r, dims)
            zones = r["zones"]
            least, most = score_bounds(vectors, np.array([z["low"] for z in zones], np.int64).reshape(len(zones), dims),
                                       np.array([z["high"] for z in zones], np.int64).reshape(len(zones), dims))
            need = np.zeros(least.shape, bool)
            size = np.array([sum(z["counts"]) for z in zones])
            held = {k: np.array([dict(zip(z["labels"], z["counts"])).get(k, 0) for z in zones]) for k in set(labels.tolist())}
            if windows:
                for w in r["windows"]:
                    i = w["at"]
                    need[i] |= (held[int(labels[i])] < size) & (most[i] >= w["low"]) & (least[i] <= w["high"])
            else:
                for i, label in enumerate(labels.tolist()):
                    need[i] = (held[label] > 0) & (most[i] >= floors[i])
            at = np.flatnonzero(need.any(0)).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([r["pack"]] * len(at), pa.int64()),
                                              pa.array([zones[j]["block"] for j in at], pa.int64())], names=["pack", "block"])


def _found(pack: int, hits: list, names: list[str]) -> pa.RecordBatch:
    """Hits (number, ids, scores) of one pack and block as rows."""
    at = [n for n, ids, _ in hits for _ in range(len(ids))]
    ids, scores = (np.concatenate([np.empty(0, np.int64), *(h[c] for h in hits)]) for c in (1, 2))
    return pa.RecordBatch.from_arrays([pa.array([pack] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array(ids), pa.array(scores)],
                                      names=names)


def _first(at: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` rows of ``at`` with the highest scores, equal ones by smaller id."""
    at = at[np.lexsort((ids[at], -scores[at]))][:k]
    return ids[at], scores[at]


def _positives(batches, dims: int, k: int):
    """At most ``k`` best same-label rows of each anchor in a block."""
    for batch in batches:
        for r in batch.to_pylist():
            own, kinds, vectors, floors = _anchors(r, dims)
            ids, labels = np.array(r["ids"], np.int64), np.array(r["row_labels"], np.int64)
            scores = inner_products(vectors, _matrix(r["vectors"], len(ids), dims))
            able = (labels == kinds[:, None]) & (ids != own[:, None]) & (scores >= floors[:, None])
            hits = [(i, *_first(np.flatnonzero(able[i]), ids, scores[i], k)) for i in np.flatnonzero(able.any(1)).tolist()]
            yield _found(r["pack"], hits, ["pack", "at", "positive_id", "positive_score"])


def _negatives(batches, dims: int, k: int):
    """At most ``k`` best different-label rows of each window of each anchor in a block."""
    for batch in batches:
        for r in batch.to_pylist():
            _, kinds, vectors, _ = _anchors(r, dims)
            ids, labels = np.array(r["ids"], np.int64), np.array(r["row_labels"], np.int64)
            scores = inner_products(vectors, _matrix(r["vectors"], len(ids), dims))
            hits = []
            for n, w in enumerate(r["windows"]):
                own = scores[w["at"]]
                at = np.flatnonzero((own >= w["low"]) & (own <= w["high"]) & (labels != kinds[w["at"]]))
                if len(at):
                    hits.append((n, *_first(at, ids, own, k)))
            yield _found(r["pack"], hits, ["pack", "window", "negative_id", "negative_score"])


def _read_by(packs: DataFrame, blocks: DataFrame, zones: DataFrame, shards: int, dims: int, windows: bool) -> DataFrame:
    """Packs next to every block that they must read: one row per pair, the block's rows beside the pack's anchors."""
    dealt = packs.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    pairs = dealt.join(zones, "shard").mapInArrow(partial(_choose, dims=dims, windows=windows), "pack long, block long")
    pairs = write_checkpoint_table(pairs, "block-reads")
    return pairs.join(packs, "pack").join(blocks.select("block", "ids", "row_labels", "vectors"), "block")


def hard_negatives(table: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   every: int = ANCHOR_EVERY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Only vec_id, embedding and label are read, so other columns may have any
    name.  Rows with a NULL id, label or vector, or a NULL or non-finite
    component take no part; shorter vectors count as zero-padded; rows that
    repeat as a whole count once, rows that repeat an id with another vector
    are candidates (and anchors) of their own, never positives of that id.
    Equal scores come by smaller id.  A positive without a negative in its
    window, an anchor without a positive and an empty table give no rows.
    """
    blocks, dims = build_blocks(clean_vectors(table).distinct(), block_rows, every, positives)
    shards = max(1, -(-blocks.select("block").count() // ZONE_SHARD))
    zones = write_checkpoint_table(
        blocks.select(F.pmod(F.xxhash64("block"), F.lit(shards)).alias("shard"),
                      F.struct("block", "low", "high", "labels", "counts").alias("zone"))
              .groupBy("shard").agg(F.collect_list("zone").alias("zones")), "zones")
    packs = write_checkpoint_table(
        blocks.filter(F.size("anchor_ids") > 0).groupBy("pack").agg(F.sort_array(F.collect_list(F.struct(
            "block", "anchor_ids", "anchor_labels", "anchor_vectors", "floors"))).alias("anchors")), "packs")

    found = _read_by(packs, blocks, zones, shards, dims, False).mapInArrow(
        partial(_positives, dims=dims, k=positives), "pack long, at long, positive_id long, positive_score long")
    best = Window.partitionBy("pack", "at").orderBy(F.desc("positive_score"), "positive_id")
    # Whole-number ends of each score window; a negative score has none.
    score = F.col("positive_score").cast("decimal(38,0)")
    chosen = (found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
              .withColumn("low", F.ceil(score * low / 100).cast("long")).withColumn("high", F.floor(score * high / 100).cast("long"))
              .filter("low <= high"))
    windows = chosen.groupBy("pack").agg(F.sort_array(F.collect_list(
        F.struct("at", "place", "positive_id", "positive_score", "low", "high"))).alias("windows"))
    asked = write_checkpoint_table(packs.join(windows, "pack"), "windows")

    hits = _read_by(asked, blocks, zones, shards, dims, True).mapInArrow(
        partial(_negatives, dims=dims, k=negatives), "pack long, window long, negative_id long, negative_score long")
    order = Window.partitionBy("pack", "window").orderBy(F.desc("negative_score"), "negative_id")
    hits = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    named = asked.select("pack", F.flatten("anchors.anchor_ids").alias("ids"), F.posexplode("windows").alias("window", "w"))
    named = named.select("pack", F.col("window").cast("long").alias("window"), F.col("ids")[F.col("w.at")].alias("anchor_id"),
                         "w.positive_id", "w.positive_score")
    return hits.join(named, ["pack", "window"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
