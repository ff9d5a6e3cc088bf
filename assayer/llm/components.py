"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.scratch import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of (a, b) reaches.

    Large stars and small stars in turn: every node points its neighbours at the smallest of them,
    first those above itself, then those below, until nothing moves. Long chains halve in every
    round. Rounds are written to the shared folder; nodes with many edges are summed up before the
    shuffle, and their joins can be split.
    """
    spark = edges.sparkSession
    a, b = F.col("a"), F.col("b")
    links = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    links, before = written(links, "links"), None
    while True:
        both = links.union(links.select(b.alias("a"), a.alias("b")))
        # Written, so that the joins are between two shuffles that Spark can split at a hot node.
        least = written(both.groupBy("a").agg(F.least(F.min("b"), a).alias("m")), "least")
        stars = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct()
        stars = written(stars, "stars")
        lowest = written(stars.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        moved = stars.join(lowest, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        links = written(moved.union(lowest.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == before or now[0] == 0:
            break
        before = now
    nodes = links.groupBy(a.alias("node")).agg(F.min("b").alias("component"))
    return written(nodes.union(nodes.select(F.col("component").alias("node"), "component").distinct()), "components")


def joined_components(parts: DataFrame, more: DataFrame) -> DataFrame:
    """(node, component) of `parts` after further links (a, b), which are few."""
    if more.isEmpty():
        return parts
    of = lambda side: parts.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    ends = more.join(of("a"), "a", "left").join(of("b"), "b", "left")
    up = components(ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    risen = parts.join(up.select(F.col("node").alias("component"), F.col("component").alias("_up")), "component", "left")
    every = risen.select("node", F.coalesce("_up", "component").alias("component")).union(up)
    return written(every.groupBy("node").agg(F.min("component").alias("component")), "components")
