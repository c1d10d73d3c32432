"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislecast.session import stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or the smaller and own) neighbours of every node below the smallest.

    A minimum and a join instead of a window, as a node may have most edges.
    """
    near = _both(edges) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    joined = near.join(low, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).union(
            low.select("u", F.col("low").alias("v"))
        )
    out = out.filter(F.col("u") != F.col("v"))
    return out if large else out.distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node of an edge (u, v).

    Each round is a written table; it stops when a round changes nothing. What
    reaches the driver is one row a round.
    """
    current = stage(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        current = stage(_stars(_stars(current, large=True), large=False), "edges")
        row = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)
