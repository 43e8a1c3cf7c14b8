"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: longs); component is the smallest node.

    Each round points every node's larger neighbours, then its smaller ones, at the smallest node
    among them. A round keeps one row per link at most, no neighbour list is gathered, and the
    number of rounds grows with the logarithm of the longest path. Every round is a stored table.
    """
    def pull(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        return edges.join(least, "u")

    def tree(links: DataFrame) -> DataFrame:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = pull(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = pull(large)
        return small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct()

    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u != v").distinct(), name)
    last = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == last or not mark[0]:
            break
        last, edges = mark, stored(tree(edges), name)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
