"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(around: DataFrame) -> DataFrame:
    """Each row (a, b) with the least of a and all b of a as ``least``; the least comes from map-side combined sums."""
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return around.join(least, "a")


def _are_stars(links: DataFrame) -> bool:
    """Whether each node that has a lesser one has no other, and is the lesser one of none."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("outer")), F.struct(F.col("b").alias("node"), F.lit(0).alias("outer")))
    nodes = links.select(F.inline(ends)).groupBy("node").agg(F.sum("outer").alias("outer"), F.count("*").alias("links"))
    return nodes.where("outer > 0 AND links > 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """node, component: the least node each node of ``links`` (a, b) reaches.

    Links of a node with itself, repeated links and links with a null end add nothing. The number of rounds grows with the
    logarithm of the number of nodes, and is 0 where the links are stars around their least nodes, as pairs are; each round is
    written, and the driver only sees whether stars are left.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    while not _are_stars(links):
        large = _star(_both_ways(links)).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b")
        small = _star(large)
        small = small.select("b", "least").union(small.select("a", "least").distinct()).toDF("a", "b")
        links = written(small.where("a <> b").distinct(), "links")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(links.select("b", "b").distinct())
