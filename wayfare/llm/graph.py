"""Connected components of a links table, by alternating stars over DataFrames.

No node's neighbours are ever gathered: minima are partial aggregates and the
rest are joins, which Spark can split at a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import drop, store


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, root): each node of a link with the smallest node it reaches, as a stored table."""
    edges = store(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        floor = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(floor, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(floor.select("a", F.col("m").alias("b")))
        old, edges = edges, store(small.where("a <> b").distinct(), "stars")
        drop(old)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    roots = store(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct(), "roots")
    drop(edges)
    return roots
