"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored


def _is_settled(links: DataFrame) -> bool:
    """Whether each node has one link, to a node that has none."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("own")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("own"))
    )
    roles = ends.groupBy("node").agg(F.sum("own").alias("links"), F.min("own").alias("least"))
    return roles.filter("links > 1 OR (links = 1 AND least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node it is connected to) of every node in the edges (a, b), but the least one's own.

    Large-star and small-star steps take turns until each node points at a
    node that points nowhere. Minima are pre-aggregated in each task and
    joined back, so a node with very many neighbours is not gathered anywhere.
    Every round is a stored table.
    """
    links = stored(
        edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    while not _is_settled(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
