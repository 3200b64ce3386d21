"""Connected components of an edge table, by alternating star operations on DataFrames."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweir.llm.tables import staged


def merge_labels(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``labels`` (each item's smallest known peer) after joining the items of each pair."""
    while left.size:
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            break
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped
    return labels


def connected(edges: DataFrame) -> DataFrame:
    """``a, b``: every node that has a smaller node in its component, and the smallest one.

    ``edges`` has two long columns ``a, b``; loops are dropped, repeats and directions do not
    matter, and an empty table gives an empty table. Each round links all larger neighbours of
    a node, then all smaller ones, to the smallest (large star, small star); the rounds needed
    grow with the logarithm of the node count. Minima are combined before the shuffle and
    written first, so that both sides of the join with them are plain exchanges and a hub's
    edges can be split over tasks. Nothing but two numbers a round reaches the driver.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = staged(edges.distinct(), "edges")
    seen = _digest(edges)
    while seen[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: every larger neighbour of a node goes to the node's smallest neighbour.
        edges = _star(both, lambda df: df.where("b > a").select(F.col("b").alias("a"), F.least("low", "a").alias("b")))
        # Small star: a node and its smaller neighbours go to the smallest of these.
        edges = _star(
            edges,
            lambda df: df.select(F.explode(F.array(F.struct("a", "low"), F.struct(F.col("b").alias("a"), "low"))).alias("e"))
            .select("e.a", F.col("e.low").alias("b"))
            .where("a <> b"),
        )
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges


def _star(edges: DataFrame, relink: Callable[[DataFrame], DataFrame]) -> DataFrame:
    low = staged(edges.groupBy("a").agg(F.min("b").alias("low")), "lows")
    return staged(relink(edges.join(low, "a")).distinct(), "edges")


def _digest(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
    return row["n"], row["x"]


def lowest_reachable(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, component, root``: for each row of ``nodes`` (node long and unique, first) the
    smallest ``first`` of its component, and the component's smallest node. ``edges`` has node columns
    ``a, b``. Nodes without edges, mostly nearly all, are left out until the last join."""
    star = connected(edges)
    star = star.unionAll(star.select("b", "b").toDF("a", "b").distinct())
    members = staged(star.join(nodes, star["a"] == nodes["node"]).select("a", "b", "first"), "members")
    lowest = staged(members.groupBy("b").agg(F.min("first").alias("lowest")), "lowest")
    linked = staged(members.join(lowest, "b").select(F.col("a").alias("node"), F.col("b").alias("root"), "lowest"), "linked")
    found = nodes.join(linked, "node", "left")
    return staged(found.select("node", F.coalesce("lowest", "first").alias("component"), F.coalesce("root", "node").alias("root")), "components")
