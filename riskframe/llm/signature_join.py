"""Exact n-gram Jaccard self-join with signature trees (operator 12).

A document's set holds its distinct shingles (A-Z folded); equal sets form one
node, so copies never meet each other.

1. One scan gives each set its size, a 128-bit sum, its k smallest hashes (the
   tokens), a bitmap with one bit for each token, and the bits of its ``FINE``
   smallest hashes in a wider bitmap.
2. Two sets at the threshold share ``need`` tokens, so they share one among
   each one's first ``length - need + 1`` in order of rising frequency.  Each
   such token gathers its members, dealt into blocks of about ``BLOCK``.
3. A block becomes a signature tree: a node holds the OR of its children's
   bitmaps, the range of their set sizes and the largest number of tokens that
   share a bit.  Two nodes are walked together.  No two sets below them can
   share more tokens than the common bits plus the smaller of the two excesses,
   and no set outside the size range can match, so a pair of nodes is dropped
   as soon as that is less than the threshold asks for.
4. First round: every block against itself.  Each member proposes its likeliest
   partner of smaller id, and exact Jaccard on full sets confirms or rejects it.
5. Second round: tokens with further pairs (several blocks, or more partners
   than proposed) and several components so far.  Every pair of their blocks
   is walked on the wider bitmaps, nodes inside one component are dropped, a
   pair leaves the walk at its first common token alone, and each remaining
   pair is confirmed exactly.  No token, member or pair is capped.
6. Components of all confirmed links, named by the smallest document id.

``need`` is the binomial 1e-9 tail of the k smallest hashes of a union, so a
pair at exactly the threshold is missed in step 2 with that probability, and
others less; sets of up to k shingles are compared whole and never missed.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import SET_KEY, components, named_components, node_texts, same_id_edges, set_nodes
from riskframe.llm.words import gram_hashes, mix, slices, word_hashes
from riskframe.session import write_checkpoint_table

WIDTH, PERCENT = 4, 85
#: Tokens of a set, bits of a bitmap, members of a block and children of a tree node.
TOKENS, BITS, BLOCK, FAN = 64, 1024, 256, 4
#: Tokens and bits of the second round; sets of up to ``FINE`` shingles are held whole.
FINE, FINE_BITS = 512, 8192
#: 64-bit words of bitmaps that are compared at once.
_AT_ONCE = 1 << 20
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def shared_tokens(tokens: int, percent: int, tail: float = 1e-9) -> int:
    """Tokens that two sets at the threshold share but for a probability of ``tail``."""
    p, below = percent / 100, 0.0
    for o in range(tokens + 1):
        below += math.comb(tokens, o) * p ** o * (1 - p) ** (tokens - o)
        if below > tail:
            return o
    return tokens


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; with fewer words, one hash of them all; without words, none."""
    words, rows = word_hashes(column, lower=True)
    grams = gram_hashes(words, width).view(np.int64)
    sets = []
    for s, e in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if e - s >= width:
            sets.append(np.unique(grams[s:e - width + 1]))
        else:
            sets.append(gram_hashes(words[s:e] ^ np.uint64(e - s), e - s).view(np.int64) if e > s else np.empty(0, np.int64))
    return sets


def _bitmaps(tokens: list[np.ndarray], bits: int) -> np.ndarray:
    """One bit per token, as rows of bytes."""
    out = []
    for s in range(0, len(tokens), 1024):  # unpacked, a bitmap takes a byte a bit
        part = tokens[s:s + 1024]
        flags = np.zeros((len(part), bits), np.uint8)
        flags[np.repeat(np.arange(len(part)), [len(t) for t in part]), np.concatenate(part) & (bits - 1)] = 1
        out.append(np.packbits(flags, axis=1))
    return np.concatenate(out) if out else np.empty((0, bits // 8), np.uint8)


def _binary(rows) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _scan(batches, width: int, k: int, bits: int):
    for b in slices(batches, "text", 1 << 20):
        sets = shingle_sets(b.column("text"), width)
        kept = [s[:k] for s in sets]
        sums = np.array([(mix(u).sum(), mix(u ^ _SALT).sum()) for u in (s.view(np.uint64) for s in sets)],
                        np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("t"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sums[:, 0]), pa.array(sums[:, 1]),
             pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, kept)]), pa.int32()), pa.array(np.concatenate(kept))),
             _binary(_bitmaps(kept, bits)), _binary((s[:FINE] & (FINE_BITS - 1)).astype(np.uint16) for s in sets)],
            names=["doc_id", "t", "n", "f1", "f2", "tokens", "bitmap", "fine"])


def _confirm(batches, width: int, percent: int):
    for b in slices(batches, "text_a", 1 << 20):
        linked = []
        for x, y in zip(shingle_sets(b.column("text_a"), width), shingle_sets(b.column("text_b"), width)):
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= percent * (len(x) + len(y) - both))
        kept = b.filter(pa.array(linked, pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])


class Forest:
    """Signature trees of several blocks, level by level; each level holds the nodes of all blocks, block by block.

    ``sizes`` gives the members of each block.  Leaves are ordered inside
    their block by component and set size, so that nodes stay narrow.
    """

    def __init__(self, sizes: np.ndarray, node: np.ndarray, n: np.ndarray, component: np.ndarray, bitmap: np.ndarray, k: int):
        block = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((node, n, component, block))
        self.order, self.node, words = order, node[order], bitmap[order].view(np.uint64)
        size, comp = n[order], component[order]
        excess = np.minimum(size, k) - np.bitwise_count(words).sum(1, dtype=np.int64)
        self.levels = [{"bits": words, "low": size, "high": size, "excess": excess, "first": comp, "last": comp}]
        self.child = [np.arange(len(order) + 1)]  # start of each node's children, one entry more than nodes
        counts = sizes.astype(np.int64)
        while counts.max(initial=1) > 1:
            up = -(-counts // FAN)
            inner = np.arange(up.sum()) - np.repeat(np.cumsum(up) - up, up)
            start = np.repeat(np.cumsum(counts) - counts, up) + inner * FAN
            below = self.levels[-1]
            self.levels.append({
                "bits": np.bitwise_or.reduceat(below["bits"], start, axis=0),
                **{c: np.minimum.reduceat(below[c], start) for c in ("low", "first")},
                **{c: np.maximum.reduceat(below[c], start) for c in ("high", "excess", "last")}})
            self.child.append(np.append(start, counts.sum()))
            counts = up

    def raise_to(self, depth: int) -> None:
        """Add levels of one-child roots."""
        while len(self.levels) < depth:
            self.levels.append(self.levels[-1])
            self.child.append(np.arange(len(self.levels[-1]["low"]) + 1))


def walk(left: Forest, right: Forest, percent: int, k: int, need: int, mirrored: bool = False):
    """Leaf pairs (indices into both forests, and the most tokens they can share) of equal-numbered blocks
    that may link and lie in different components.

    ``mirrored``: both are the same forest, and each pair is wanted once.
    """
    depth = max(len(left.levels), len(right.levels))
    left.raise_to(depth)
    right.raise_to(depth)
    roots = np.arange(len(left.levels[-1]["low"]))
    once = max(1, _AT_ONCE // left.levels[0]["bits"].shape[1])
    todo = [(depth - 1, roots[s:s + once], roots[s:s + once]) for s in range(0, len(roots), once)]
    while todo:
        level, i, j = todo.pop()
        a, b = left.levels[level], right.levels[level]
        low_a, low_b, high_a, high_b = a["low"][i], b["low"][j], a["high"][i], b["high"][j]
        able = 100 * np.minimum(high_a, high_b) >= percent * np.maximum(low_a, low_b)
        if not (mirrored and level):  # a node paired with itself may hold several members of a component
            able &= ~((a["first"][i] == a["last"][i]) & (b["first"][j] == b["last"][j]) & (a["first"][i] == b["first"][j]))
        if mirrored:
            able &= (i < j) if level == 0 else (i <= j)
        i, j, high = i[able], j[able], np.maximum(high_a, high_b)[able]
        whole = -(-percent * (low_a + low_b)[able] // (100 + percent))
        asked = np.where(high <= k, whole, np.minimum(need, whole))
        most = np.bitwise_count(a["bits"][i] & b["bits"][j]).sum(1, dtype=np.int64) + np.minimum(a["excess"][i], b["excess"][j])
        i, j, most = i[most >= asked], j[most >= asked], most[most >= asked]
        if level == 0:
            if len(i):
                yield i, j, most
            continue
        ca, cb = left.child[level], right.child[level]
        na, nb = ca[i + 1] - ca[i], cb[j + 1] - cb[j]
        pairs = na * nb
        at = np.repeat(np.arange(len(i)), pairs)
        inner = np.arange(len(at)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        x, y = ca[i][at] + inner // nb[at], cb[j][at] + inner % nb[at]
        todo += [(level - 1, x[s:s + once], y[s:s + once]) for s in range(0, len(x), once)]


def _members(column: pa.Array, k: int) -> Forest:
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten()
    number = lambda c: flat.field(c).to_numpy(zero_copy_only=False)
    if flat.type.get_field_index("fine") >= 0:
        data = _bitmaps([np.frombuffer(v, np.uint16).astype(np.int64) for v in flat.field("fine").to_pylist()], FINE_BITS)
    else:
        data = np.frombuffer(b"".join(flat.field("bitmap").to_pylist()), np.uint8).reshape(len(flat), -1)
    return Forest(sizes, number("node"), number("n"), number("component"), data, k)


def _cut(batches, column: str, limit: int = 1 << 15):
    """Cut batches so that ``column``'s lists hold about ``limit`` members in each (one row at least)."""
    for b in batches:
        total = np.cumsum(np.diff(b.column(column).offsets.to_numpy())) // limit
        edge = [0, *(np.flatnonzero(np.diff(total)) + 1).tolist(), len(b)]
        yield from (b.slice(s, e - s) for s, e in zip(edge, edge[1:]) if e > s)


def _first_round(batches, percent: int, k: int, need: int):
    """Each member's likeliest partner of smaller id (a < b), and the tokens whose blocks have more pairs than that."""
    for b in _cut(batches, "members"):
        forest = _members(b.column("members"), k)
        node, tokens = forest.node, np.minimum(forest.levels[0]["low"], k)
        block = np.repeat(np.arange(len(b)), np.diff(b.column("members").offsets.to_numpy()))
        by_id = np.argsort(node, kind="stable")
        rank = np.empty(len(node), np.int64)
        rank[by_id] = np.arange(len(node))
        best = np.full(len(node), -1)
        pairs = np.zeros(len(b), np.int64)
        for i, j, most in walk(forest, forest, percent, k, need, mirrored=True):
            share = 1000 * most // (tokens[i] + tokens[j] - most)
            later, earlier = np.where(rank[i] < rank[j], j, i), np.minimum(rank[i], rank[j])
            np.maximum.at(best, later, share * len(node) + len(node) - 1 - earlier)  # equal shares: the smaller id
            np.add.at(pairs, block[i], 1)
        found = np.flatnonzero(best >= 0)
        partner = node[by_id[len(node) - 1 - best[found] % len(node)]]
        more = np.flatnonzero(pairs > np.bincount(block[found], minlength=len(b)))
        none = pa.nulls(len(more), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(partner), none]), pa.concat_arrays([pa.array(node[found]), none]),
             pa.concat_arrays([pa.nulls(len(found), pa.int64()), b.column("value").take(pa.array(more))])], names=["a", "b", "value"])


def _earlier(column: pa.Array, forest: Forest) -> list[frozenset]:
    """Each leaf's tokens before the one that gathers its block."""
    tokens = column.flatten().field("earlier").to_pylist()
    return [frozenset(tokens[p]) for p in forest.order.tolist()]


def _second_round(batches, percent: int, k: int, need: int):
    """All pairs (a < b) of different components in two blocks of a token, but those that share an ``earlier`` one.

    An earlier common token has settled its pair: closed ones proposed all
    their pairs, those inside one component need none, the others are walked here.
    """
    for b in _cut(_cut(batches, "members", 1 << 13), "others", 1 << 13):
        left, right = _members(b.column("members"), k), _members(b.column("others"), k)
        before, behind = _earlier(b.column("members"), left), _earlier(b.column("others"), right)
        itself = np.repeat(b.column("itself").to_numpy(zero_copy_only=False), np.diff(b.column("members").offsets.to_numpy()))
        for i, j, _ in walk(left, right, percent, k, need):
            x, y = left.node[i], right.node[j]
            once = np.flatnonzero(np.where(itself[i], x < y, x != y))  # a block against itself meets each pair twice
            first = [before[p].isdisjoint(behind[q]) for p, q in zip(i[once].tolist(), j[once].tolist())]
            x, y = x[once][first], y[once][first]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, k: int = TOKENS) -> DataFrame:
    """Per row: doc_id, n_shingles (its own set's size), component_id.

    Only ``doc_id`` (a whole number) and ``text`` are read, so other columns
    may have any name.  NULL, empty and word-less texts have an empty set and
    link with nothing.  Whole rows that repeat are one set.  An id that
    repeats with different texts is one document: it joins the components of
    all its texts.  Rows with a NULL doc_id are not compared (component NULL).
    An empty table gives an empty result.
    """
    need = shared_tokens(k, percent)
    tree = {"percent": percent, "k": k, "need": need}
    fine = {"percent": percent, "k": FINE, "need": shared_tokens(FINE, percent)}
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    scan = write_checkpoint_table(base.mapInArrow(
        partial(_scan, width=width, k=k, bits=BITS), "doc_id long, t long, n long, f1 long, f2 long, tokens array<long>, bitmap binary, fine binary"), "signatures")
    nodes = write_checkpoint_table(set_nodes(scan), "nodes")
    sets = write_checkpoint_table(
        scan.join(nodes.withColumnRenamed("rep", "doc_id"), [*SET_KEY, "doc_id"]).dropDuplicates(["node"])
            .select("node", "doc_id", "t", "n", "tokens", "bitmap", "fine"), "sets")

    # The rarest tokens of each set, among those that several sets hold.
    entries = sets.select(F.explode("tokens").alias("value"), "node")
    shared = entries.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = entries.join(shared, "value").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("held"))
    must = F.least(F.lit(need), F.ceil(F.col("n") * percent / 100))
    room = F.size("held") - must + 1  # tokens that no other set holds come first and are left out
    members = (ranked.join(sets.select("node", "n", "bitmap"), "node").withColumn("room", room.cast("int")).filter("room > 0")
               .select("node", "n", "bitmap", "held", F.posexplode(F.slice("held", F.lit(1), F.col("room"))).alias("at", "v"))
               .select(F.col("v.value").alias("value"), F.ceil(F.col("v.df") / BLOCK).cast("long").alias("blocks"), "node", "n", "bitmap",
                       F.slice(F.col("held.value"), F.lit(1), F.col("at")).alias("earlier"))
               .withColumn("block", F.pmod(F.xxhash64("node", "value"), F.col("blocks"))))
    members = write_checkpoint_table(members, "members")

    # First round: every block against itself.
    blocks = members.groupBy("value", "block").agg(F.collect_list(
        F.struct("node", "n", F.col("node").alias("component"), "bitmap")).alias("members")).filter(F.size("members") > 1)
    first = write_checkpoint_table(blocks.select("value", "members").mapInArrow(
        partial(_first_round, **tree), "a long, b long, value long"), "first-round")
    proposed = write_checkpoint_table(first.filter("a is not null").select("a", "b").distinct(), "proposed")
    links = write_checkpoint_table(_verified(proposed, base, sets, width, percent), "links")
    so_far = components(links)

    # Second round: open tokens whose members lie in several components.
    opened = first.filter("a is null").select("value").union(members.filter("blocks > 1").select("value")).distinct()
    open_members = write_checkpoint_table(
        members.drop("bitmap").join(opened, "value", "left_semi").join(so_far, "node", "left")
               .withColumn("component", F.coalesce("component", "node")), "open-members")
    mixed = open_members.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    mixed_blocks = write_checkpoint_table(
        open_members.join(mixed.select("value"), "value", "left_semi").join(sets.select("node", "fine"), "node")
                    .groupBy("value", "block", "blocks").agg(
                        F.collect_list(F.struct("node", "n", "component", "fine", "earlier")).alias("members")), "mixed-blocks")
    walked = (mixed_blocks.withColumn("other", F.explode(F.expr("sequence(block, blocks - 1)")))
              .join(mixed_blocks.select("value", F.col("block").alias("other"), F.col("members").alias("others")), ["value", "other"])
              .select("members", "others", (F.col("block") == F.col("other")).alias("itself"))
              .mapInArrow(partial(_second_round, **fine), "a long, b long"))
    rest = write_checkpoint_table(walked.join(proposed, ["a", "b"], "left_anti"), "second-round")
    more = _verified(rest, base, sets, width, percent)

    parts = write_checkpoint_table(components(links.unionByName(more).unionByName(same_id_edges(scan, nodes))), "parts")
    return named_components(scan, nodes, parts).withColumnRenamed("n", "n_shingles")


def _verified(pairs: DataFrame, base: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs of nodes (a, b) whose full sets reach the threshold."""
    used = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    texts = write_checkpoint_table(node_texts(base, sets.select("node", "doc_id", "t").join(used, "node")), "texts")
    side = lambda s: texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(
        partial(_confirm, width=width, percent=percent), "a long, b long")
