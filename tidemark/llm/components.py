"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources import scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of a link.

    ``links`` has the columns u and v. Nodes are tied to ever smaller neighbours (large-star
    and small-star steps) until nothing changes; each round is a written table, so that lost
    executors cost one round at most. A node with very many neighbours is a hot join key of
    the larger side, which adaptive execution splits.
    """
    low, high = F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")
    edges = scratch.written(links.filter("u != v").select(high, low).distinct(), "links")
    before = None
    while (state := _state(edges)) != before and state[0]:
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m"))
        smallest = smallest.select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), "m")
        large = large.select("u", F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = scratch.written(
            small.filter("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "links",
        )
    named = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return named.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
