"""Connected components of a graph of links, by alternating star contractions.

Each round is two aggregations and two joins on node ids and is written to the
shared folder; the number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import materialise


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): smallest node reachable, for every node with a link to another node."""
    edges = materialise(
        links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where("u <> v").distinct(), "links")
    mark = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if (now.n, now.x) == mark or not now.n:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(
                F.min("component").alias("component"))
        mark = (now.n, now.x)
        edges = materialise(_small_star(_large_star(edges)), "stars")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
