"""Connected components of an edge table, as Spark jobs only.

Alternates the two star operations (large-star: link every larger neighbour to
the smallest neighbour; small-star: link the smaller ones to it) until nothing
changes. Every round is two aggregations and two joins on node ids, its result
is a written table; nothing is collected but one checksum a round. The number
of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _smallest(down)
    linked = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return linked.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); component is its smallest node.

    Nodes without an edge do not occur. Self loops and repeated edges are fine.
    """
    now = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u != v").distinct(),
                 "edges")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        now = stored(_small_star(_large_star(now)), "stars")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
