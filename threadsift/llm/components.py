"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.common import materialize


def _stars(links: DataFrame) -> DataFrame:
    """One large star and one small star step; links are (a, b) with a > b."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = materialize(large.distinct())
    # Now every link leads down; each node hands its smaller neighbours to the least of them.
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return materialize(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())


def _fingerprint(links: DataFrame) -> tuple:
    """One row that changes when the links do."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), total).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of a table of links (a, b); a component's name is its least node.

    Links to oneself and repeated links do no harm. Each round is written to the shared
    folder, and the rounds end when one changes nothing.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while (now := _fingerprint(edges)) != before and now[0]:
        before = now
        edges = _stars(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
