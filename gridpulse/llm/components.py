"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: links of each node move to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.join(least, "u")
    if large:
        return moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    kept = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return kept.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, left: str, right: str, rounds: int = 60) -> DataFrame:
    """(id, component_id) of every linked node: the smallest id that links lead to.

    Rounds grow with the logarithm of the longest chain. Each is written to the shared folder, which
    cuts the lineage; only a count and a checksum reach the driver.
    """
    edges = edges.where(F.col(left) != F.col(right))
    edges = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    edges, before = cut(edges.distinct()), None
    for _ in range(rounds):
        # u > v here, so every node but the smallest of a component is some u.
        edges = cut(_star(_star(edges, True), False))
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)
