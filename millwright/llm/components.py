"""Connected components of an edge table, without collecting anything.

Alternating large-star and small-star rounds contract every component to a star
round its smallest node. Each round is two aggregations with map-side combine
and two equi-joins, so a hub with a large share of the edges is pre-aggregated
in the first and split by adaptive skew handling in the second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, drop_scratch


def _hooked(directed: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest node of u's neighbourhood."""
    low = directed.groupBy("u").agg(F.min("v").alias("m"))
    return directed.join(low, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _hooked(both)
    return linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _hooked(down)
    moved = linked.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(linked.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct()


def _settled(stars: DataFrame) -> bool:
    """Whether every edge (u, v) leads from a node to a root: no v is a u, and each u has one v."""
    inner = stars.join(stars.select(F.col("u").alias("v")).distinct(), "v", "left_semi").select("u")
    return not inner.union(stars.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")).limit(1).count()


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Columns ``node`` and ``component`` (its smallest node) for each node of an edge.

    ``edges`` has two columns of one orderable type; loops and rows with a null
    are ignored, repeated edges count once. An empty table gives no rows. Raises
    ``RuntimeError`` if the rounds do not settle, which only a graph with paths
    beyond any practical length can cause.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u != v")
    now, path = stored(now.distinct(), "edges")
    for _ in range(max_rounds):
        new, new_path = stored(_small_star(_large_star(now)), "stars")
        drop_scratch(spark, path)
        now, path = new, new_path
        if _settled(now):
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())


def merged_components(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """``parts`` (node, component) after more edges (u, v); only components that edges touch are worked on.

    A node that ``parts`` lacks is a component of its own before.
    """

    if edges.isEmpty():
        return parts

    def of(name: str) -> DataFrame:
        return parts.select(F.col("node").alias(name), F.col("component").alias(f"c_{name}"))

    ends = edges.toDF("u", "v").join(of("u"), "u", "left").join(of("v"), "v", "left")
    between = ends.select(F.coalesce("c_u", "u").alias("u"), F.coalesce("c_v", "v").alias("v"))
    moved = connected_components(between).select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = parts.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    new = moved.select(F.col("component").alias("node"), F.col("to").alias("component")).join(parts.select("node"), "node", "left_anti")
    return old.union(new)
