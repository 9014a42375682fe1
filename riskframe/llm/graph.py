"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import write_checkpoint_table


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable.

    Each round gives a node the smallest label among its neighbours and then
    jumps to that label's own label, so long chains shrink geometrically.
    Labels are written to the shared folder each round.  Self-loops and
    repeated edges are harmless; an empty edge list gives an empty table.
    """
    both = write_checkpoint_table(
        edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = write_checkpoint_table(
        both.groupBy(F.col("a").alias("node"))
            .agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        seen = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                    .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        step = (labels.join(seen, "node")
                      .select("node", F.least("component", "near").alias("component"),
                              F.col("component").alias("old")))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        new = write_checkpoint_table(
            step.join(jump, "component", "left")
                .select("node", F.least("component", "root").alias("component"), "old"), "labels")
        changed = not new.filter("component <> old").isEmpty()
        labels = new.select("node", "component")
        if not changed:
            return labels


#: A set's key: its size and the 128-bit sum over it.
SET_KEY = ["n", "f1", "f2"]


def set_nodes(scan: DataFrame) -> DataFrame:
    """(n, f1, f2, rep, node): one node for each set of ``scan`` (doc_id, n, f1, f2), named by its smallest id.

    An id that is the smallest of several sets (it repeats with different
    texts) names the first of them; the others get a negative hash.
    """
    sets = scan.filter("n > 0 and doc_id is not null").groupBy(*SET_KEY).agg(F.min("doc_id").alias("rep"))
    first = sets.groupBy("rep").agg(F.min(F.struct(*SET_KEY)).alias("first"))
    other = -1 - F.xxhash64(*SET_KEY).bitwiseAND(F.lit((1 << 62) - 1))
    return sets.join(first, "rep").select(*SET_KEY, "rep", F.when(
        F.struct(*SET_KEY) == F.col("first"), F.col("rep")).otherwise(other).alias("node"))


def same_id_edges(scan: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b) edges that tie the nodes of an id's texts together."""
    owned = scan.filter("n > 0 and doc_id is not null").join(nodes, SET_KEY).select("doc_id", "node")
    twice = owned.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("hi")).filter("a < hi")
    return owned.join(twice, "doc_id").select("a", F.col("node").alias("b")).filter("a <> b").distinct()


def named_components(scan: DataFrame, nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """(doc_id, n, component_id) per row of ``scan``: the smallest id of its component (node, component); NULL for a NULL id."""
    named = nodes.join(parts, "node")
    named = named.join(named.groupBy("component").agg(F.min("rep").alias("smallest")), "component").select(*SET_KEY, "smallest")
    return (scan.join(nodes, SET_KEY, "left").join(named, SET_KEY, "left")
            .select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "rep", "doc_id")).alias("component_id")))


def node_texts(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the rows of ``base`` (doc_id, t, text) that ``wanted`` (node, doc_id, t) names; ``t`` hashes the text."""
    return base.join(wanted, ["doc_id", "t"]).select("node", "text").dropDuplicates(["node"])
