"""Connected components of an edge table, by joins only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def spanning_edges(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the given
    edges connect: at most one per node, however many edges come in."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[:len(u)], flat[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        new = np.minimum(new, new[label])
        if np.array_equal(new, label):
            break
        label = new
    keep = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[keep], nodes[label[keep]]


def components(edges: DataFrame) -> DataFrame:
    """(u long, v long) -> (node, component), component being its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each
    round points every node to smaller neighbours until only stars are left,
    after a number of rounds that grows with the logarithm of the longest
    path.  Minima are aggregates and the rest are joins, so the neighbours of
    a node are never gathered; each round's edges are written to shared
    storage.  Nodes without an edge to another node are not returned."""
    edge = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edge, seen = written(edge, "edges"), None
    while True:
        state = edge.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return edge.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edge.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = state
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = written(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edge = written(small, "small")
