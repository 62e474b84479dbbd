"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction. Large: every larger neighbour of a node is linked to the least one around it. Small: every
    smaller neighbour, and the node itself, is. The least neighbours are written first: an aggregate on the key of the
    join would keep adaptive execution from splitting the edges of a hub."""
    if large:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "edges_least")
        linked = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "edges_least")
        linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return linked.where("u <> v").dropDuplicates()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u, v``) that is not the least of its component, which is
    its root. Rows stay proportional to the edges: neighbourhoods are contracted to stars, never listed."""
    at = stored(edges.select("u", "v").where("u <> v").dropDuplicates(), "edges")
    before = None
    while True:
        at = stored(_star(_star(at, large=True), large=False), "edges")
        mark = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return at.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
