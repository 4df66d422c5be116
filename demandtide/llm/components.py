"""Connected components of an edge table: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandtide.llm import base


def _digest(links: DataFrame) -> tuple:
    """Count and two sums of hashes of distinct links."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum(F.xxhash64("b", "a", F.lit(1)).cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (columns ``a, b`` of one type): the label is the
    smallest node that links reach.

    A large star links every node's larger neighbours to its smallest one, a small star the smaller
    ones; both only ever move links towards smaller nodes and keep what is connected connected. The
    links end as one star for each component, after a number of rounds that grows with the
    logarithm of the longest chain. Each round is written, so the plan stays short.
    """
    stars = base.kept(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    last = _digest(stars)
    while True:
        both = stars.union(stars.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = base.kept(both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        moved = small.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = base.kept(moved.union(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        # The same links as before: they have come to rest.
        now = _digest(new)
        if now == last:
            return new.select(F.col("a").alias("node"), F.col("b").alias("label")).union(new.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        stars, last = new, now
