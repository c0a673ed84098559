"""Connected components of a set of links, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.shared import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that the links (a, b) reach from each node named in them.

    Alternates two steps until nothing changes: every larger neighbour of a node moves to
    the node's smallest neighbour, then every smaller one does. Stars stay as many rows as
    they have members, and each round's links are written to the shared folder.
    """
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut_lineage(large, "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        moved = cut_lineage(small.select("e.*").where("u <> v").distinct(), "links")
        if _digest(moved) == _digest(edges):
            return moved.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(moved.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        edges = moved


def _digest(edges: DataFrame) -> tuple:
    """Row count and an order-free sum over all links: one row to the driver."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
