"""Connected components of a table of links, on Spark, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.base import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b: long); the root is
    the least node of its component.

    Alternates two rewirings that keep components and end in stars around the
    least nodes: every node hands its larger neighbours, then its smaller ones,
    to the least neighbour it knows. Each uses a minimum per node (combined
    before the shuffle) and a join back, so a node with very many links is never
    one task's work. Each round is written to the shared folder.
    """
    pairs = (links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
             .where("a < b").distinct())
    now = materialise(pairs, "links")
    seen = None
    while True:
        # larger neighbours of every node go to the least of its neighbourhood
        both = now.select(F.col("a").alias("n"), F.col("b").alias("m")).union(
            now.select(F.col("b").alias("n"), F.col("a").alias("m")))
        least = both.groupBy("n").agg(F.min("m").alias("l")).select("n", F.least("n", "l").alias("l"))
        large = (both.where("m > n").join(least, "n").select(F.col("l").alias("a"), F.col("m").alias("b"))
                 .where("a < b").distinct())
        large = materialise(large, "links")
        # a node and its smaller neighbours go to the least of them
        low = large.groupBy("b").agg(F.min("a").alias("l"))
        joined = large.join(low, "b")
        now = materialise(joined.select(F.col("l").alias("a"), F.col("a").alias("b"))
                          .union(low.select(F.col("l").alias("a"), F.col("b").alias("b")))
                          .where("a < b").distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
