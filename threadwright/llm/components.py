"""Connected components of a link table by alternating large and small stars.

Every round is two aggregations (combined before the shuffle) and two joins with a table of one
row per node, then a table in the shared folder: no node's links are ever gathered, lineage stays
short, and the rounds grow with the logarithm of the size of a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` run from the larger to the smaller id."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(``id``, ``component``) of every id that has a link; the component is its smallest id.

    Links may repeat and point either way; links of an id with itself are ignored. Ids that have no
    link are not listed. An empty table gives no rows.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    rows = links.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    rows = staged(rows.distinct(), "links")
    state = None
    while True:
        seen = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
        if not state[0]:
            break
        rows = staged(_small_star(_large_star(rows)), "links")
    members = rows.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return members.unionByName(rows.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


class Forest:
    """Union-find over positions 0..n-1 inside one task; the root is the smallest position."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True
