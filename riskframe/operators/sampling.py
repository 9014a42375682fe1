"""Reproducible sampling and exact stratified splitting.

Rows are ordered by a seeded hash of the id -- ``md5(id || ':' || seed)``,
first 60 bits, ties broken by the id -- which is independent of partitioning
and reproducible in any SQL engine.  A sample or a split is then a plain
filter on that order: the hash of the row at a wanted position is found from
counts per hash range, each pass looking 12 bits deeper into the ranges that
hold a cut, until a range is so small that its few ids settle the cut.  No
row moves, and a class of any size costs the same few counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.names import quote
from riskframe.spec import CV_FOLDS, SEED, TEST_SHARE

HASH_BITS, STEP_BITS = 60, 12
#: A hash range of at most this many rows is settled by its ids.
KEPT = 2_000


def hash_key(id_col: str, seed: int = SEED) -> Column:
    """60 bits of the seeded hash of the id; a NULL id hashes as an empty text."""
    digest = F.md5(F.concat(F.coalesce(F.col(quote(id_col)).cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


@dataclass(frozen=True)
class Cut:
    """The place of one position in the hash order of a class; ``tied`` rows of the id at the cut lie before it."""

    hash: int
    id: object
    tied: int = 0


def _first(cut: Cut, h: Column, i: Column) -> Column:
    """Rows strictly before the id at the cut (a NULL id comes first)."""
    at = h == F.lit(cut.hash)
    if cut.id is None:
        return h < F.lit(cut.hash)
    return (h < F.lit(cut.hash)) | (at & (i.isNull() | (i < F.lit(cut.id))))


def _at(cut: Cut, h: Column, i: Column) -> Column:
    return (h == F.lit(cut.hash)) & i.eqNullSafe(F.lit(cut.id))


def find_cuts(df: DataFrame, id_col: str, seed: int, ranks: Callable[[int], Sequence[int]],
              target: str | None = None) -> tuple[dict, dict[tuple, Cut]]:
    """(rows of each class, (class, rank) -> :class:`Cut` of the row at each 0-based rank of the class's hash order).

    ``ranks`` gives the wanted ranks for a class of so many rows; those
    outside of it are left out.  Without ``target`` all rows are the class
    None; a NULL target raises.  Every pass counts hash ranges of the classes
    and ids only; what returns is one row per range that may hold a cut.
    """
    group = F.lit(None).cast("string") if target is None else F.col(quote(target))
    rows = df.select(group.alias("g"), hash_key(id_col, seed).alias("h"), F.col(quote(id_col)).alias("i"))
    sizes: dict = {}
    todo: dict[tuple, list[tuple[int, int]]] | None = None  # (class, hash prefix) -> (rank, rank inside)
    cuts, depth = {}, 0
    while todo is None or todo:
        depth += STEP_BITS
        prefix = F.shiftright("h", HASH_BITS - depth)
        inside = rows if todo is None else rows.where(_in_ranges(todo, HASH_BITS - depth + STEP_BITS))
        counts = inside.groupBy("g", prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        if todo is None:
            for r in counts:
                sizes[r.g] = sizes.get(r.g, 0) + r.n
            if target is not None and None in sizes:
                raise ValueError(f"NULL in target {target}")
            todo = {(g, 0): own for g, n in sizes.items() if (own := [(r, r) for r in sorted(set(ranks(n))) if 0 <= r < n])}
        next_todo, small = {}, {}
        for (g, p), wanted in todo.items():
            start = 0
            for r in sorted((r for r in counts if r.g == g and r.p >> STEP_BITS == p), key=lambda r: r.p):
                here = [(rank, at - start) for rank, at in wanted if start <= at < start + r.n]
                if here:
                    (small if r.n <= KEPT or depth == HASH_BITS else next_todo)[(g, r.p)] = here
                start += r.n
        if small:
            # At most KEPT ids a range (one hash at full depth), counted where they repeat.
            ids = rows.where(_in_ranges(small, HASH_BITS - depth)).groupBy("g", "h", "i").agg(F.count(F.lit(1)).alias("n")).collect()
            for (g, p), wanted in small.items():
                start = 0
                own = [r for r in ids if r.g == g and r.h >> (HASH_BITS - depth) == p]
                for r in sorted(own, key=lambda r: (r.h, r.i is not None, r.i)):
                    cuts.update({(g, rank): Cut(r.h, r.i, at - start) for rank, at in wanted if start <= at < start + r.n})
                    start += r.n
        todo = next_todo
    return sizes, cuts


def _in_ranges(ranges: dict, shift: int) -> Column:
    test = F.lit(False)
    for g, p in ranges:
        test = test | (F.col("g").eqNullSafe(F.lit(g)) & (F.shiftright("h", shift) == F.lit(p)))
    return test


def sample_n(df: DataFrame, n: int, id_col: str, seed: int = SEED, target: str | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, uniform without replacement (I1), or
    that many of each class of ``target`` (I2).  The row cap is the operator's
    purpose (the reference fits PCA/k-means on a 20,000-row sample).  Where the
    last wanted row repeats an id, any of its rows make up the number."""
    sizes, cuts = find_cuts(df, id_col, seed, lambda size: [n], target)
    h, i = hash_key(id_col, seed), F.col(quote(id_col))
    group = F.lit(True) if target is None else None
    kept, ties = F.lit(False), []
    for g in sizes:
        own = group if target is None else F.col(quote(target)) == F.lit(g)
        cut = cuts.get((g, n))
        kept = kept | (own if cut is None else own & _first(cut, h, i))
        if cut is not None and cut.tied:
            ties.append(df.where(own & _at(cut, h, i)).limit(cut.tied))
    out = df.where(kept)
    for t in ties:
        out = out.unionAll(t)
    return out


def stratified_split(df: DataFrame, id_col: str, target: str, test_share: float = TEST_SHARE,
                     folds: int = CV_FOLDS, seed: int = SEED) -> DataFrame:
    """Adds ``is_test`` (0/1) and ``fold`` (0..folds-1 for training rows, NULL
    for test rows) (I3, I4).

    Inside each class the first floor(share * n_class + 0.5) rows in hash
    order are the test rows, so class proportions are exact; the training rows
    after them form ``folds`` ranges of the same order, floor(folds * place /
    training rows of the class), so fold sizes differ by at most one per class.
    Rows that repeat an id stay together.  A NULL target belongs to no class:
    it raises.
    """
    def ends(n: int) -> list[int]:
        """Where the test rows end and where each later fold starts."""
        n_test = int(n * test_share + 0.5)
        return [n_test + -(-k * (n - n_test) // folds) for k in range(folds)]

    sizes, cuts = find_cuts(df, id_col, seed, ends, target)
    h, i = F.col("_h"), F.col(quote(id_col))
    place = None
    for g, n in sizes.items():
        # Cuts that a row has reached: 0 for a test row, k + 1 in fold k.
        reached = F.lit(0)
        for e in ends(n):
            if e < n:
                reached = reached + (~_first(cuts[g, e], h, i)).cast("int")
        own = F.col(quote(target)) == F.lit(g)
        place = F.when(own, reached) if place is None else place.when(own, reached)
    staged = df.withColumn("_h", hash_key(id_col, seed)).withColumn("_place", F.lit(0) if place is None else place)
    return staged.select(*[F.col(quote(c)) for c in df.columns], (F.col("_place") == 0).cast("int").alias("is_test"),
                         F.when(F.col("_place") > 0, F.col("_place") - 1).cast("int").alias("fold"))
