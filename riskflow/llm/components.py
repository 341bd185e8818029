"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import stored


def _lowest(pairs: DataFrame) -> DataFrame:
    """``u, v`` pairs with the lowest neighbour (or ``u`` itself) of each ``u`` as ``m``."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(low.select("u", F.least("u", "m").alias("m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    )
    linked = _lowest(both).filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the higher to the lower node."""
    low = _lowest(edges)
    moved = low.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    centre = edges.groupBy("u").agg(F.min("v").alias("v"))
    return moved.unionByName(centre).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges (u, v)``; the label is the lowest node linked.

    Each round is a few aggregations and joins whose partial sums merge on the map side, so a
    node with very many links is never gathered. Rounds end when the edge set no longer changes.
    """
    high = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = stored(edges.filter("u != v").select(*high).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen, now = mark, stored(_small_star(_large_star(now)), "edges")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
