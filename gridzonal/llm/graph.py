"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.storage import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or smaller and own) neighbours of every node to its smallest one."""
    both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))) if large else edges.select(
        F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")
    )
    least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("low"))
    joined = both.join(least, "x")
    if large:
        moved = joined.filter("y > x").select(F.col("y").alias("x"), F.col("low").alias("y"))
    else:
        moved = joined.select(F.col("y").alias("x"), F.col("low").alias("y")).unionByName(
            least.select("x", F.col("low").alias("y"))
        )
    return moved.filter("x <> y").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether no node but the smallest of a component has several edges: edges lead from the larger node to the smaller."""
    lower = edges.select(F.col("x").alias("node"), F.lit(1).alias("up"))
    ends = lower.unionByName(edges.select(F.col("y").alias("node"), F.lit(0).alias("up")))
    roles = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least_up"))
    return roles.filter("ups > 1 OR ups = 1 AND least_up = 0").agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge (x, y)."""
    larger, smaller = F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")
    current = materialise(edges.filter("x <> y").select(larger, smaller).distinct(), "edges")
    while not _settled(current):
        current = materialise(_star(_star(current, True), False), "stars")
    roots = current.select(F.col("y").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(roots)
