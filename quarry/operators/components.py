"""Connected components of an edge table, by joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect what the edges a-b between the nodes 0
    to n - 1 connect: one at most per node, to the smallest of its group."""
    parent = np.arange(n)
    while True:
        low = np.minimum(parent[a], parent[b])
        before = parent.copy()
        np.minimum.at(parent, parent[a], low)
        np.minimum.at(parent, parent[b], low)
        parent = parent[parent]
        if np.array_equal(parent, before):
            break
    node = np.flatnonzero(parent != np.arange(n))
    return node, parent[node]


def connected(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): the smallest node reachable.  Each round every
    node takes the smallest label among its own and its neighbours', and then
    its label's label, so the rounds grow with the logarithm of the longest
    path for the most part; labels are minima (combined before the shuffle)
    and neighbours are never gathered.  Nodes of no edge are not returned."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.distinct())
    label = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")))
    while True:
        near = both.join(label.select(F.col("a").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = label.join(near, "a").select("a", "root", F.least("root", "near").alias("low"))
        # the label's own new label, found by another join on the (far fewer) labels in use
        hook = step.select(F.col("root").alias("at"), F.col("low").alias("to")).where("at <> to")
        hook = hook.groupBy("at").agg(F.min("to").alias("to"))
        step = step.join(hook, F.col("low") == F.col("at"), "left")
        new = cut_lineage(step.select("a", F.col("root").alias("old"), F.least("low", F.coalesce("to", "low")).alias(
            "root")))
        moved = new.where("old <> root").limit(1).count()
        label = new.select("a", "root")
        if not moved:
            return label.select(F.col("a").alias("node"), "root")
