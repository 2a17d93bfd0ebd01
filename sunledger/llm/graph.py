"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.session import materialize


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[root]
        if np.array_equal(new, root):
            return root
        root = new


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over ``links``, for each node that has a link to another node.

    Each round lets every node with a smaller neighbour hook to its smallest one, halves the chains until all point at a
    root, and contracts the links to roots; at least half of the roots with a link are gone after a round. NULL ends
    link nothing. Rounds are written tables, so a lost executor repeats one round at most.
    """

    def normal(x: DataFrame) -> DataFrame:
        ends = x.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        return ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    edges = materialize(normal(links.select(F.col(a).alias("a"), F.col(b).alias("b"))), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    result = None
    while True:
        parent = materialize(edges.groupBy("a").agg(F.min("b").alias("p")), "parents")
        while True:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            jumped = materialize(parent.join(up, "p", "left").select("a", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")), "parents")
            moved = not jumped.where("moved").isEmpty()
            parent = jumped.select("a", "p")
            if not moved:
                break
        root = parent.select(F.col("a").alias("root"), F.col("p").alias("up"))
        if result is None:
            result = nodes.join(root.withColumnRenamed("root", "node"), "node", "left").select("node", F.coalesce("up", "node").alias("component"))
        else:
            result = result.join(root.withColumnRenamed("root", "component"), "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        left, right = root.withColumnsRenamed({"root": "a", "up": "ra"}), root.withColumnsRenamed({"root": "b", "up": "rb"})
        again = edges.join(left, "a", "left").join(right, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        edges = materialize(normal(again), "links")
        if edges.isEmpty():
            return materialize(result, "components")
