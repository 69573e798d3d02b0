"""Connected components of a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sensorloom.llm.tables import saved


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach from each linked node.

    Large and small stars by turns: each node hands its larger, then its smaller
    neighbours to the smallest node it knows, until nothing changes.  Every round
    is two partial minima and two joins, which adaptive execution splits where
    one node has very many links; rounds grow with the logarithm of the number
    of nodes.  Whether a round changed anything is observed while it is written.
    Nodes without links to others don't appear; nulls link nothing.
    """
    start = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    mark, (current, now) = None, _written(start.distinct())
    while now != mark:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(nearest, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.inline(F.array(
                F.struct(F.col("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )))
            .filter("u <> v")
            .distinct()
        )
        mark, (current, now) = now, _written(small)
    ends = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return ends.unionByName(roots)


def _written(pairs: DataFrame) -> tuple[DataFrame, dict]:
    """The pairs as a table, and figures that tell whether two such tables are the same."""
    seen = Observation()
    figures = (
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("hash"),
        F.min("u").alias("least"), F.max("u").alias("most"),
    )
    return saved(pairs.observe(seen, *figures), "links"), seen.get


class Forest:
    """Union-find over the rows of one block; keeps the pairs that joined two trees."""

    def __init__(self, size: int) -> None:
        self.parent = list(range(size))
        self.joined: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        x_root, y_root = self.find(x), self.find(y)
        if x_root != y_root:
            self.parent[y_root] = x_root
            self.joined.append((x, y))

    def pairs_of(self, ids: np.ndarray) -> list[tuple[int, int]]:
        return [(int(ids[x]), int(ids[y])) for x, y in self.joined]

    def stars_of(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Each tree as links to its least id, which blocks of one crowd mostly have in common."""
        rows = {row for pair in self.joined for row in pair}
        least: dict[int, int] = {}
        for row in rows:
            root, own = self.find(row), int(ids[row])
            least[root] = min(own, least.get(root, own))
        stars = ((int(ids[row]), least[self.find(row)]) for row in sorted(rows))
        return [(own, centre) for own, centre in stars if own != centre]
