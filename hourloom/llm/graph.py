"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.sources.workspace import settle_narrow


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or only larger ones: then each star is a component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("top")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("low"), F.lit(1).alias("top")))
    return ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("top").alias("top")).filter("low > 1 or (low = 1 and top = 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every linked node; the component is its smallest node.

    Each round is two aggregations with a join back, written to the shared folder, so lineage stays short and
    nothing but "done" reaches the driver. Stars of any size shrink by partial aggregation. Null ends
    and self links say nothing and are left out.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = settle_narrow(edges, "links")
    while not _is_star_forest(edges):
        edges = settle_narrow(_small_star(_large_star(edges)), "stars")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
