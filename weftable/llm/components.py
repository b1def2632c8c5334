"""Connected components of an undirected graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def _are_stars(edges: DataFrame) -> bool:
    """Whether each ``u`` hangs on one ``v`` that hangs on nothing: as ``u > v``, on the smallest node of its component."""
    ends = edges.select(F.posexplode(F.array("v", "u")).alias("hangs", "node"))
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.count("*").alias("ends"))
    return nodes.filter("hangs > 1 or hangs = 1 and ends > 1").count() == 0


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` (its smallest node) of every node that has a link.

    ``links``, best a written table, is read several times. Each round needs two sums and two joins over the links, is
    written, and hangs nodes on smaller ones, until all hang on the smallest of theirs; links that do so from the start take no
    round. A node with very many links is only ever a minimum, summed up before the shuffle.
    """
    x, y = F.col(a), F.col(b)
    edges = links.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
