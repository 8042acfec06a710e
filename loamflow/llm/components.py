"""Connected components of an edge table, by alternating large-star and small-star steps.

Neighbourhoods are never collected: a step takes the least neighbour of each vertex (a map-side
combined minimum) and joins it back to the edges. Each round's edges are written to the shared
folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (u, v): towards the least of its neighbours and itself, each vertex moves
    its larger neighbours (large star) or itself and its smaller ones (small star)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
    return moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, root): the least vertex of the component of every vertex that has an edge to another
    and isn't its component's least. ``edges`` holds longs (u, v) in any order, repeats and loops
    allowed; no edges give no rows."""
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u <> v").distinct(), "cc")
    while not _is_starred(now):
        now = materialize(_star(_star(now, True), False), "cc")
    return now.select("u", F.col("v").alias("root"))


def _is_starred(edges: DataFrame) -> bool:
    """Whether every vertex has one edge down, to a vertex that has none."""
    forked = edges.groupBy("u").count().where("count > 1").select("u")
    chained = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
    return forked.union(chained).isEmpty()
