"""Connected components of links between numbered nodes, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetfeatures.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its least node.

    A star step hands each node's neighbours to its least neighbour: a sum per node and a join, so a node with very
    many links is split as any skewed join is. Rounds grow with the logarithm of the longest chain.
    """
    edges = written(_ordered(links))
    seen = None
    while True:
        edges = written(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
        if seen == now:
            break
        seen = now
    stars = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())


def _ordered(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "centre")
    moved = both.filter("v > u").join(least, F.col("u") == F.col("centre"))
    return moved.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "centre")
    moved = edges.join(least, F.col("hi") == F.col("centre"))
    down = moved.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return down.unionAll(least.select(F.col("centre").alias("hi"), F.col("m").alias("lo"))).distinct()
