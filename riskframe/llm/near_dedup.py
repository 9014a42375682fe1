"""Near-duplicate detection with bottom-k sketches of one hash function (operator 9).

A document's set holds its distinct five-word shingles (A-Z folded).  The flow:

1. One scan hashes every shingle with one function and keeps the k smallest
   values (the sketch), the set size and a 128-bit sum over the whole set.
2. Documents with equal sets form a class; its smallest id stands for it, so
   groups of copies of any size become one node by a map-side aggregate.
3. Inverted lists of the retained values, rarest first: two sets at the
   threshold share ``need`` sketch values, so they share one among each one's
   first ``size - need + 1`` values.  Common passages rank last and drop out.
4. In each list the members meet two pivots only (the member with the most
   common values, and the smallest id): rows grow with the list, not its
   square.  The sketch of the union estimates the similarity and drops far
   pairs; the exact Jaccard on full sets confirms the rest.
5. Lists that still hold several components are settled exactly: their
   documents enter a rarest-first prefix join on *full* sets, where only pairs
   of different components are verified.  No list, partner or candidate is capped.
6. Components of all confirmed links (smallest reachable id).

``need`` is the binomial 1e-9 tail of the union sketch, so step 3 misses a
pair at exactly the threshold with that probability, and others less.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.graph import SET_KEY, components, named_components, node_texts, same_id_edges, set_nodes
from riskframe.llm.words import gram_hashes, mix, slices, word_hashes
from riskframe.session import write_checkpoint_table

WIDTH, PERCENT, SKETCH = 5, 75, 64
_SALT = np.uint64(0xA24BAED4963EE407)


def needed_overlap(k: int, percent: int, tail: float = 1e-9) -> int:
    """Largest o with P(Binomial(k, percent/100) < o) <= tail."""
    p, below, o = percent / 100, 0.0, 0
    while True:
        below += math.comb(k, o) * p ** o * (1 - p) ** (k - o)
        if below > tail:
            return o
        o += 1


def _sets(column: pa.Array, width: int):
    """The shingle set of each row as sorted distinct int64 values."""
    words, rows = word_hashes(column, lower=True)
    grams = gram_hashes(words, width).view(np.int64)
    for s, e in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if e - s >= width:
            yield np.unique(grams[s:e - width + 1])
        else:
            yield gram_hashes(words[s:e] ^ np.uint64(e - s), e - s).view(np.int64) if e > s else np.empty(0, np.int64)


def _scan(batches, width: int, k: int):
    for b in slices(batches, "text", 1 << 20):
        sets = list(_sets(b.column("text"), width))
        kept = [s[:k] for s in sets]
        offs = np.cumsum([0, *map(len, kept)]).astype(np.int32)
        sums = np.array([(mix(u).sum(), mix(u ^ _SALT).sum()) for u in (s.view(np.uint64) for s in sets)],
                        np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("t"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sums[:, 0]),
             pa.array(sums[:, 1]), pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(kept)))],
            names=["doc_id", "t", "n", "f1", "f2", "sketch"])


def _explode(batches, width: int):
    for b in slices(batches, "text"):
        sets = list(_sets(b.column("text"), width))
        size = np.array([len(s) for s in sets])
        take = np.repeat(np.arange(len(sets)), size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(sets)), b.column("doc_id").take(pa.array(take)),
             b.column("component").take(pa.array(take)), pa.array(size[take].astype(np.int64))],
            names=["value", "id", "component", "n"])


def _confirm(batches, width: int, percent: int):
    for b in slices(batches, "text_a"):
        keep = []
        for x, y in zip(_sets(b.column("text_a"), width), _sets(b.column("text_b"), width)):
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        chosen = b.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], names=["a", "b"])


def _verified(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, width: int, percent: int,
              k: int, need: int) -> DataFrame:
    """Links among candidate ``pairs`` (a, b): union-sketch estimate first, exact Jaccard after."""
    side = lambda t, s, c: t.select(F.col("doc_id").alias(s), F.col(c).alias(f"{c}_{s}"))
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    near = (pairs.join(side(sketches, "a", "sketch"), "a").join(side(sketches, "b", "sketch"), "b")
            .withColumn("u", union)
            .withColumn("x", F.size(F.array_intersect(F.array_intersect("u", "sketch_a"), "sketch_b")))
            .filter(F.when(F.size("u") < k, 100 * F.col("x") >= percent * F.size("u")).otherwise(F.col("x") >= need))
            .select("a", "b"))
    near = write_checkpoint_table(near, "near")
    full = near.join(side(texts, "a", "text"), "a").join(side(texts, "b", "text"), "b")
    return full.select("a", "b", "text_a", "text_b").mapInArrow(
        partial(_confirm, width=width, percent=percent), "a long, b long")


def _similar_sizes(percent: int):
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, k: int = SKETCH) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Only ``doc_id`` and ``text`` are read, so other columns may have any name.
    NULL, empty or word-less texts have an empty set and link with nothing.
    ``doc_id`` is a whole number.  Rows that repeat as a whole are one set; an
    id that repeats with different texts is one document: it joins the
    components of all its texts, each row with its own set's size.  Rows with
    a NULL doc_id are not compared (component NULL, kept).  An empty table
    gives an empty result.
    """
    need = needed_overlap(k, percent)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    scan = write_checkpoint_table(
        base.mapInArrow(partial(_scan, width=width, k=k),
                        "doc_id long, t long, n long, f1 long, f2 long, sketch array<long>"), "sketches")
    nodes = write_checkpoint_table(set_nodes(scan), "nodes")
    named = write_checkpoint_table(
        scan.join(nodes.withColumnRenamed("rep", "doc_id"), [*SET_KEY, "doc_id"]).dropDuplicates(["node"])
            .select("node", "doc_id", "t", "n", "sketch"), "representatives")
    sketches = named.select(F.col("node").alias("doc_id"), "n", "sketch")

    # Inverted lists of retained values, cut to each sketch's rarest ones.
    entries = sketches.select(F.explode("sketch").alias("value"), F.col("doc_id").alias("id"), "n")
    shared = entries.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = entries.join(shared, "value").groupBy("id", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("vals"))
    length = F.least(F.col("n"), F.lit(k))
    must = F.least(F.lit(need), F.ceil(F.col("n") * percent / 100)).cast("int")
    room = (length - must + 1 - (length - F.size("vals"))).cast("int")
    lists = write_checkpoint_table(
        ranked.withColumn("room", room).filter("room > 0")
              .select("id", "n", F.aggregate("vals", F.lit(0.0), lambda s, v: s + F.log2(v["df"])).alias("common"),
                      F.explode(F.slice("vals", F.lit(1), F.col("room"))).alias("v"))
              .select(F.col("v.value").alias("value"), "id", "n", "common"), "lists")

    listed_nodes = lists.select(F.col("id").alias("node")).distinct()
    texts = write_checkpoint_table(
        node_texts(base, named.select("node", "doc_id", "t").join(listed_nodes, "node")).withColumnRenamed("node", "doc_id"), "texts")
    listed = write_checkpoint_table(sketches.join(texts.select("doc_id"), "doc_id", "left_semi"), "listed")
    verify = partial(_verified, sketches=listed, texts=texts, width=width, percent=percent, k=k, need=need)

    # Every member against its list's two pivots.
    pivots = lists.groupBy("value").agg(
        F.max(F.struct("common", "id", "n")).alias("p"), F.min(F.struct("id", "n")).alias("q"), F.count("*").alias("df")
    ).filter("df > 1").select(
        "value", F.array(F.struct("p.id", "p.n"), F.struct("q.id", "q.n")).alias("pivots"))
    pairs = (lists.join(pivots, "value").select(F.col("id").alias("a"), F.col("n").alias("n_a"),
                                                F.explode("pivots").alias("p"))
             .select("a", "n_a", F.col("p.id").alias("b"), F.col("p.n").alias("n_b"))
             .filter("a <> b").filter(_similar_sizes(percent))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    star = write_checkpoint_table(verify(pairs), "links")
    parts = components(star)

    # Lists with several components: rarest-first prefix join on full sets.
    member = (lists.join(parts.withColumnRenamed("node", "id"), "id", "left")
              .withColumn("component", F.coalesce("component", "id")))
    mixed = member.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    open_ids = write_checkpoint_table(
        member.join(mixed.select("value"), "value", "left_semi").select(F.col("id").alias("doc_id"), "component")
              .distinct(), "open")
    full = texts.join(open_ids, "doc_id").select("doc_id", "text", "component").mapInArrow(
        partial(_explode, width=width), "value long, id long, component long, n long")
    full = write_checkpoint_table(full, "shingles")
    many = full.groupBy("value").agg(F.count("*").alias("df"), F.min("component").alias("lo"),
                                     F.max("component").alias("hi")).filter("df > 1")
    by_doc = Window.partitionBy("id")
    rare = (full.join(many, "value")
            .withColumn("m", F.count("*").over(by_doc))
            .withColumn("rn", F.row_number().over(by_doc.orderBy("df", "value")))
            .withColumn("left", F.col("m") - F.col("rn") + 1)  # values from this one on, itself included
            .filter(F.col("left") >= F.ceil(F.col("n") * percent / 100))
            .filter("lo < hi").select("value", "id", "component", "n", "left"))
    rare = write_checkpoint_table(rare, "prefixes")
    # At a pair's first common value, what is left on either side bounds the overlap; per component, by its best member.
    bound = lambda left_b, n_b: (100 + percent) * F.least("left_a", left_b) >= percent * (F.col("n_a") + F.col(n_b))
    other = rare.groupBy("value", F.col("component").alias("other")).agg(F.max("left").alias("left_c"), F.min("n").alias("n_c"))
    cross = (rare.withColumnsRenamed({"id": "a", "n": "n_a", "left": "left_a"})
             .join(other, "value").filter("other < component").filter(bound("left_c", "n_c"))
             .join(rare.select("value", F.col("component").alias("other"), F.col("id").alias("b"),
                               F.col("n").alias("n_b"), F.col("left").alias("left_b")), ["value", "other"])
             .filter(bound("left_b", "n_b"))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rest = verify(cross)
    final = components(star.union(rest).union(same_id_edges(scan, nodes)))
    return (named_components(scan, nodes, final).withColumnRenamed("n", "n_shingles")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
