"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the node, so no neighbourhood is ever gathered in one place, and the
number of steps grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Landing


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def component_roots(links: DataFrame, landing: Landing, name: str) -> DataFrame:
    """(node, root) for every node of `links(u, v)`; the root is the smallest node that can be reached.

    Self links count as nodes. An empty table gives an empty table.
    """
    nodes = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    edges = landing.land(links.where("u <> v").distinct(), f"{name}-0")
    before, step = _state(edges), 0
    while before[0]:
        step += 1
        edges = landing.land(_small_star(_large_star(edges)), f"{name}-{step}")
        after = _state(edges)
        landing.drop(f"{name}-{step - 1}")
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
