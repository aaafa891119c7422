"""Connected components of links between nodes, by turns of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import kept


def _star(edges: DataFrame, to_smaller: bool) -> DataFrame:
    """Each node joins its larger (or smaller) neighbours to the smallest node it knows."""
    lowest = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    both = edges.join(lowest, "a")
    if to_smaller:
        lower = both.where("b < a")
        return lower.select(F.col("b").alias("a"), F.col("low").alias("b")).union(lower.select("a", F.col("low").alias("b"))).where("a <> b").distinct()
    return both.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable. Hot nodes stay split over
    tasks: a node's smallest neighbour is an aggregate with map-side part, then joined back, never a list."""
    edges = kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    sign = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, to_smaller=False)
        edges = kept(_star(large, to_smaller=True))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == sign:
            break
        sign = tuple(now)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
