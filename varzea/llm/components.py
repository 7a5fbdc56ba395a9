"""Connected components of a link table by alternating star contraction.

Large-star ties every larger neighbour of a node to the least node around it,
small-star ties the smaller ones; both keep the components and never make more
links than there were.  Repeated in turn they end in one star per component,
centred on its least node, after about log(nodes) rounds.  Each round is an
aggregation (combined map-side) and a join that Spark can split when a node is
hot, and is written to the shared folder, so a lost executor repeats one round
at most.  Nothing is collected but two numbers that tell whether a round
changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varzea.llm.common import staged


def _stars(directed: DataFrame) -> DataFrame:
    """Each link (u, v) with m, the least of u and all of u's neighbours."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return directed.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b; integers).

    ``component`` is the least node that can be reached.  Self-links are
    ignored, nulls are not links, no links give no rows."""
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every remaining link points from the larger to the smaller node
        small = _stars(large)
        ties = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = staged(ties, "links")
        after = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if before == after:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class Forest:
    """Union-find over a task's own links; keeps a spanning forest of them."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def _root(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def join(self, a: int, b: int) -> bool:
        """True if a and b were apart."""
        a, b = self._root(a), self._root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def spanning(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    forest = Forest()
    return [p for p in pairs if forest.join(*p)]
