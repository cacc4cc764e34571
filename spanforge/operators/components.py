"""Connected components of an undirected edge list, as an iterated DataFrame plan."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.session import cut

HELD_EDGES = 2_000_000  # edges that a task holds before it replaces them by trees
ROWS_OUT = 100_000
TREES = "node long, root long"


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index linked to each of ``n`` indexes."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root != root[root]).any():
            root = root[root]
        live = root[a] != root[b]
        a, b = a[live], b[live]
    return root


def trees_of(batches):
    """Edges ``(u, v)`` of a task as pairs of node and smallest node linked to it in the task; held edges are replaced by
    their trees whenever they number many."""
    held, many = [], HELD_EDGES

    def settled():
        ends = np.concatenate(held) if held else np.zeros((0, 2), "int64")
        nodes, at = np.unique(ends, return_inverse=True)
        at = at.reshape(-1, 2)
        return np.column_stack([nodes, nodes[roots_of(len(nodes), at[:, 0], at[:, 1])]])

    n = 0
    for batch in batches:
        held.append(np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
        n += len(held[-1])
        if n > many:
            held = [settled()]
            n = len(held[0])
            many = max(HELD_EDGES, 2 * n)
    out = settled()
    for i in range(0, len(out), ROWS_OUT):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[i : i + ROWS_OUT, k])) for k in (0, 1)], names=["node", "root"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node on an edge; component is the smallest node reachable.

    Each task replaces its edges by trees, so that an edge list of any length shrinks to a row per node and task. Nodes of
    several tasks link the trees' roots; only that graph of roots is settled, then every node takes the component of one
    of its roots. Null ends and self loops are ignored.
    """
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null and u <> v")
    return joined_trees(e.mapInArrow(trees_of, TREES))


def joined_trees(trees: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes of all tasks' trees ``(node, root)``."""
    trees = cut(trees)
    first = cut(trees.groupBy("node").agg(F.min("root").alias("first")))
    links = trees.join(first, "node").where("root <> first").select("root", "first").distinct()
    found = settle(links, "root", "first").select(F.col("node").alias("_root"), F.col("component").alias("_c"))
    return cut(first.join(found, first["first"] == found["_root"], "left").select("node", F.coalesce("_c", "first").alias("component")))


def settle(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of an edge list, in one task where it has at most HELD_EDGES edges, else by rounds over it.

    Each round offers the smallest label among a node's neighbours to the node and to the node that its own label names,
    so whole trees hook onto each other, and then jumps to the label's own label. Rounds go on until nothing changes;
    labels only fall, so they end. Labels are cut to the shared checkpoint folder each round; only a count of changed
    labels reaches the driver.
    """
    e = cut(edges.select(F.col(a).alias("u"), F.col(b).alias("v")))
    if e.count() <= HELD_EDGES:
        return e.repartition(1).mapInArrow(trees_of, TREES).withColumnRenamed("root", "component")
    e = cut(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut(e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("component")))
    while True:
        near = e.join(labels, e["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("m"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", "component", "m")
        offers = step.select("node", F.least("component", "m").alias("c"), F.col("component").alias("was"))
        hooks = step.where("m < component").select(F.col("component").alias("node"), F.col("m").alias("c"), F.lit(None).cast("long").alias("was"))
        step = cut(offers.unionByName(hooks).groupBy("node").agg(F.min("c").alias("c"), F.max("was").alias("was")))
        top = step.select(F.col("node").alias("t"), F.col("c").alias("tc"))
        new = cut(step.join(top, step["c"] == top["t"]).select("node", F.least("c", "tc").alias("component"), "was"))
        changed = new.where("component <> was").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
