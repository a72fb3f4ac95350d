"""Connected components over an edge DataFrame (large-star / small-star rounds).

Each round only ever joins an edge list with one minimum per vertex, so a vertex
with very many neighbours is never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchgrid.session import Scratch


def _star(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """One star pass over edges (a, b) with a > b.

    Large-star connects every larger neighbour of a vertex to the vertex's smallest
    neighbour; small-star does the same for the smaller neighbours and the vertex.
    """
    if smaller_only:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("m", "u"))
    if smaller_only:
        moved = near.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        moved = near.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.where("a > b").distinct()


def _settled(edges: DataFrame) -> bool:
    """True when every vertex hangs on one root and no root hangs on anything."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    per = ends.groupBy("v").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per.where("down > 1 OR (down > 0 AND up > 0)").isEmpty()


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, component) for every node of a non-loop edge; component = smallest node."""
    cur = (
        edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b"))
        .where("a > b")
        .distinct()
    )
    scratch = Scratch(edges.sparkSession, "components")
    cur = scratch.write(cur)
    while not _settled(cur):
        new = scratch.write(_star(_star(cur, smaller_only=False), smaller_only=True))
        scratch.drop(cur)
        cur = new
    roots = cur.select(F.col("b").alias("node")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
