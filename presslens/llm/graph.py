"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.shared import materialise

#: A round's tasks take about so many links each, and there are at least so many of them unless the session has fewer.
LINKS_A_TASK, LEAST_TASKS = 100_000, 12


class Forest:
    """Components of 0 .. n - 1 within one task, for a bounded block."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.parent[self.find(a)] = self.find(b)

    def stars(self) -> list[tuple[int, int]]:
        """A pair (root, x) of every x that isn't its component's root."""
        return [(r, x) for x in range(len(self.parent)) if (r := self.find(x)) != x]


def spanning_forest(pairs: Iterable[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Pairs that hold together what ``pairs`` link, one for each node but the roots."""
    forest = Forest(n)
    for a, b in pairs:
        forest.join(a, b)
    return forest.stars()


def _in_tasks(table: DataFrame, links: int) -> DataFrame:
    """``table`` in as many tasks as ``links`` ask for, where the session's partitions are more: the driver keeps a record of every task."""
    tasks = max(LEAST_TASKS, -(-links // LINKS_A_TASK))
    return table.coalesce(tasks) if tasks < int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")) else table


def _large_star(edges: DataFrame, links: int) -> DataFrame:
    """Each node's larger neighbours go to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _in_tasks(both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")), links)


def _small_star(edges: DataFrame, links: int) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    stars = _in_tasks(moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))), links)
    return _in_tasks(stars.distinct(), links)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges`` (a, b); a component is named by its smallest node.

    Every round is written to the shared folder, so lineage stays short; rounds
    grow with the logarithm of the longest chain. Minima are combined before
    they are shuffled, so a hub costs no more than its links.
    """
    now = materialise(edges.select("a", "b").filter("a <> b").distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(F.greatest("a", "b"), F.least("a", "b")).cast("decimal(38,0)")).alias("h")).first()
        if mark == before or mark["n"] == 0:
            break
        before = mark
        now = materialise(_small_star(_large_star(now, mark["n"]), mark["n"]), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
