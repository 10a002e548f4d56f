"""Connected components by alternating star contraction, on tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of integers to ``(node, root)``, root the smallest node
    reachable; nodes without an edge to another node do not appear.

    Large-star and small-star rounds (Kiveris et al., 2014) alternate until the
    edges no longer change, about log(n) rounds. Each round aggregates per node
    with partial aggregation and joins the minimum back on a sort-merge join
    that Spark splits when a node is hot. A round is a written table, so no
    lineage grows and nothing but two counters reaches the driver.
    """
    current = written(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    mark = _mark(current)
    while mark[0]:
        current = written(_small_star(_large_star(current)), "edges")
        before, mark = mark, _mark(current)
        if before == mark:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free digest of the edges."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its closed neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges are u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def forest(a: np.ndarray, b: np.ndarray):
    """Each node linked to the smallest of its component: at most one link a node."""
    if not len(a):
        return a, b
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[:len(a)], where[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]
