"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefunnel.operators.tables import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b), for linked nodes.

    Each round hangs the neighbours of every node under the smallest one (first
    the larger neighbours, then the smaller), until nothing changes.  A round is
    groupings and plain joins, written to the shared folder; rounds grow with the
    logarithm of a component's size.  The driver sees two numbers per round.
    """
    greatest, least = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = staged(links.where("a <> b").select(greatest, least).distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            lowest.select("u", F.col("m").alias("v"))
        )
        edges = staged(small.distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.col("m").alias("component")
    ).union(edges.select("v", "v").distinct())
