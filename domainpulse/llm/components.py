"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domainpulse.llm.common import small, stored

ROWS_PER_TASK = 50_000


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(a, b): every linked node above its component's smallest node b.  ``links`` has columns a and b.

    Large-star and small-star steps in turn (each a grouped minimum and a join back) until the edges
    stand still; after a few rounds every node points to its smallest.  Each round is written to the
    shared folder.  A hub costs one row per task in the minimum; the join back broadcasts the minima
    while they are few and may be split as a skewed join beyond that.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (now := _state(edges)) != before and now[0]:
        before = now
        tasks = -(-now[0] // ROWS_PER_TASK)  # no more tasks than the shrinking edges are worth
        both = edges.union(edges.select("b", "a"))
        least = small(stored(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).coalesce(tasks), "star"))
        large = stored(
            both.join(least, F.col("a") == F.col("u")).where("b > a")
            .select(F.col("b").alias("a"), F.least("m", "u").alias("b")).distinct().coalesce(tasks), "links")
        least = small(stored(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).coalesce(tasks), "star"))
        joined = large.join(least, F.col("a") == F.col("u"))
        edges = stored(
            joined.select("a", F.col("m").alias("b")).union(
                joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct().coalesce(tasks), "links")
    return edges


class Sets:
    """Union-find over 0 .. n-1 inside a task."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.groups = n

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
            self.groups -= 1
