"""Connected components of a graph given by edges, in rounds of aggregations and joins.

Each round links every node to the smallest node it knows of and halves the distance to it (large star,
then small star), so the number of rounds grows with the logarithm of the longest path. A node with very
many neighbours is only ever aggregated partially and joined; its neighbours are never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.storage import cut


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for all nodes of ``edges`` (a, b)."""
    links = cut(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    )
    state = None
    while True:
        # large star: every larger neighbour of a node, and the node, to the smallest it knows
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            links.select(F.col("a").alias("v"), F.col("b").alias("u"))
            .join(least.withColumnRenamed("a", "u"), "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
        )
        # small star: smaller neighbours of a node to the smallest of them
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lower, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            joined.select("a", F.col("m").alias("b"))
        )
        links = cut(small.filter("a > b").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
