"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlift.operators.pinning import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step; every node's least neighbour is found by a map-side-combined aggregation."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node of each linked node's component.

    ``edges`` has long columns ``u`` and ``v``; nodes without a link have no row.  Steps are written
    to the shared folder, repeat until nothing changes, and number about the logarithm of the longest
    chain.
    """
    current = stage(edges.where("u <> v").select("u", "v").distinct(), "links")
    state = None
    while True:
        current = stage(_star(_star(current, large=True), large=False), "stars")
        found = current.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(found) == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = tuple(found)
