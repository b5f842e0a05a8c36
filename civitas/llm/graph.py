"""Connected components of a table of links, in DataFrame operations with stored rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from civitas.llm.common import stored


def _stars(edges: DataFrame) -> bool:
    """Whether every node of the links (u, v), u > v, is either a centre or hangs on one centre."""
    rows, nodes = edges.agg(F.count(F.lit(1)), F.countDistinct("u")).first()
    return rows == nodes and not edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi").take(1)


def components(spark: SparkSession, links: DataFrame, folder: str, name: str) -> DataFrame:
    """node, root for every node of links (u, v): root is the smallest node reachable.

    Alternates large-star and small-star steps: every node hands its larger (then its
    smaller) neighbours to the smallest one it knows. The number of rows never grows
    beyond that of the links, and no link leaves the executors. A hub's rows are split
    by Spark's skew join, since both sides are stored tables.
    """
    edges = stored(spark, links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), folder, f"{name}0")
    turn = 0
    while not _stars(edges):
        turn += 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(spark, both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), folder, f"{name}{turn}a")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(spark, large, folder, f"{name}{turn}b")
        least = stored(spark, large.groupBy("u").agg(F.min("v").alias("m")), folder, f"{name}{turn}c")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = stored(spark, small.where("u <> v").distinct(), folder, f"{name}{turn}d")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
