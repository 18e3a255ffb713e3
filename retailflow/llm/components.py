"""Connected components by alternating stars, on edges only.

A large star joins a node's greater neighbours to its smallest, a small star its smaller ones; after a few turns
every component is one star around its smallest node.  A turn is two aggregations with partial minima and two
joins that Spark can split at a hot centre.  Edges are written to the shared folder after every turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    if not large:
        both = both.where(F.col("v") < F.col("u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if large:
        out = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = both.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every edge leads to the smallest node of its component: no tail has two heads, no head is a tail."""
    n = edges.agg(F.count("*"), F.count_distinct("a"), F.count_if(F.col("a") < F.col("b"))).first()
    return n[0] == n[1] and not n[2] and edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component: its smallest node) of every node on an edge (a, b); empty without edges."""
    edges = written(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "edges")
    while not _stars(edges):
        edges = written(_star(_star(edges, True), False), "edges")
    return written(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct(), "components")
