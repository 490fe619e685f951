"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import staged


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node only, which hangs on none."""
    hung = edges.groupBy(F.col("u").alias("w")).agg(F.count("*").alias("n"))
    twice = hung.where("n > 1").select("w")
    chained = edges.join(hung, F.col("v") == F.col("w"), "left_semi").select(F.col("v").alias("w"))
    return twice.union(chained).isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and comp (the smallest node it reaches) for every node that has a link.

    Large-star and small-star turns: a node's larger, then smaller, neighbours
    are hung on its smallest one, until all hang on their component's smallest
    node. Each turn is two aggregates and joins over the links; their number
    grows with the logarithm of the components' sizes.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = staged(edges, "links")
    while not _all_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.col("_u")).alias("m"))
        large = both.join(smallest, F.col("u") == F.col("_u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = staged(large.where("u <> v").distinct(), "links")
        lowest = hung.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
        small = hung.join(lowest, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(
            small.where("u <> v").union(lowest.select(F.col("_u").alias("u"), F.col("m").alias("v"))).distinct(), "links"
        )
    stars = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("comp"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return stars.union(centres)
