"""Connected components of an edge table, as DataFrame joins and grouped minima.

Alternating large-star / small-star rounds.  Each round is written to the
shared scratch folder, so no lineage builds up and a lost executor costs one
round at most.  Nothing but one row of counters per round reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollflow.llm.common import stored


def _downward(df: DataFrame) -> DataFrame:
    """Edges as distinct (u, v) with u > v."""
    return df.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                     F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least node around that node."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"),
                                                           F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).select(
        "n", F.least("n", "m").alias("m"))
    return _downward(both.where("v > u").join(least, F.col("u") == F.col("n"))
                     .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's lower neighbours and the node itself are linked to the least of them."""
    least = edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
    hung = edges.join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"),
                                                              F.col("m").alias("v"))
    return _downward(hung.unionByName(least.select(F.col("n").alias("u"),
                                                   F.col("m").alias("v"))))


def components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, root) for every node that has an edge and is not its own root.

    ``root`` is the least node reachable.  Nodes absent from the result are
    alone or are roots.  NULL ends are dropped; repeated edges and loops are
    harmless; an empty table gives an empty result.
    """
    now = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    now = stored(_downward(now.where("u is not null and v is not null")), name)
    seen = None
    while True:
        now = stored(_small_star(_large_star(now)), name)
        mark = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")),
                       F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark


def component_minimum(nodes: DataFrame, edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, value), edges (a, b) -> (node, root, component): least node and least value reachable.

    Node ids are distinct longs; NULL values are passed over (NULL only if a
    whole component has none).
    """
    roots = components(edges, "a", "b", name).withColumnRenamed("node", "_n")
    placed = stored(nodes.join(roots, F.col("node") == F.col("_n"), "left").select(
        "node", "value", F.coalesce("root", "node").alias("root")), name + "-roots")
    least = placed.groupBy(F.col("root").alias("_r")).agg(F.min("value").alias("component"))
    return stored(placed.join(least, F.col("root") == F.col("_r")).select("node", "root", "component"),
                  name + "-least")


class LocalSets:
    """Union-find over 0..n-1 with numpy, for the links found inside one task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if np.array_equal(q, p):
                self.parent = p
                return p
            p = q

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            p = self.roots()
            ra, rb = p[a], p[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))
