"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialise

EDGES_PER_TASK = 250_000


class Forest:
    """Union-find of comparable names; the smallest name of a set is its root."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def join(self, x, y) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.parent.setdefault(min(x, y), min(x, y))


def _stars(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of one task, each node linked to the smallest one it reaches there."""
    forest = Forest()
    for frame in frames:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist()):
            forest.join(a, b)
    pairs = [(x, root) for x in list(forest.parent) if (root := forest.find(x)) != x]
    yield pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Links the larger (or all other) neighbours of every node to its smallest neighbour."""
    up = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    both = up.union(up.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else up
    # written, so that both sides of the join are exchanged and a node with very many neighbours can be split
    lowest = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "lowest")
    joined = both.join(lowest, "a")
    moved = joined.filter("b > a").select("b", "m") if large else joined.select("b", "m").union(lowest)
    moved = moved.toDF("a", "b")
    return materialise(moved.filter("a <> b").distinct(), "stars")


def components(edges: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b), longs; the component is its smallest node.

    Each task first reduces its edges to stars. What several tasks hold is united by alternating large-star
    and small-star steps until nothing changes, a logarithmic number of times; each step is one
    pre-aggregated minimum and one join. Only a count and a checksum reach the driver. Edges with a null,
    loops and repeats change nothing; an empty table gives no row.
    """

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    kept = materialise(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b"), "edges")
    tasks = -(-kept.count() // edges_per_task)
    current = materialise(kept.repartition(max(tasks, 1)).mapInPandas(_stars, "a long, b long"), "stars")
    if tasks > 1:
        before = None
        while (now := state(current)) != before:
            before, current = now, _star(_star(current, large=True), large=False)
    # every edge now leads to the smallest node of its component
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(current.select("b", F.col("b").alias("c")).distinct())
