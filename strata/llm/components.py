"""Connected components of an edge table, by alternating star contractions.

Every round replaces each node's links by links to the least node near it
(large star: larger neighbours; small star: the node and smaller neighbours),
until nothing changes: then every node links to the least of its component.
Only sums and tables leave the executors; each round is stored in the shared
scratch folder. After a few rounds most links of a large component hang on one
node; such a node's links are dealt out over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import deal_join, hot_parts, stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(20,0)")),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _least_of(links: DataFrame, key: str, least) -> DataFrame:
    """(key, m, n): the least node near every node, and its links; stored, as it is read twice."""
    return stored(links.groupBy(key).agg(least.alias("m"), F.count(F.lit(1)).alias("n")), "components-least")


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least_of(both, "a", F.least(F.min("b"), F.col("a")))
    hot = hot_parts(least, "a", "n", 2 * rows)
    return (deal_join(both.filter("b > a"), least.select("a", "m"), "a", "b", hot).filter("b <> m")
            .select(F.col("m").alias("a"), "b").distinct())


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    # Every edge is (a < b): b's smaller neighbours are its a's.
    least = _least_of(edges, "b", F.min("a"))
    hot = hot_parts(least, "b", "n", rows)
    linked = (deal_join(edges, least.select("b", "m"), "b", "a", hot).filter("a <> m")
              .select(F.col("m").alias("a"), F.col("a").alias("b")))
    return linked.union(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; ``edges`` has distinct (a, b) with a < b."""
    now = stored(edges.select("a", "b").distinct(), "components")
    before, state = None, _state(now)
    while state != before:
        wide = stored(_large_star(now, state[0]), "components-large")
        now = stored(_small_star(wide, state[0]), "components")
        before, state = state, _state(now)
    members = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return members.union(now.select(F.col("a"), F.col("a")).distinct())
