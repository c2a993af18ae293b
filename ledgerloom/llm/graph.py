"""Connected components over links, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from every node of a link.

    Alternates the large-star and small-star steps: every node's larger neighbours, then its smaller ones, are linked to the
    smallest it knows, until nothing changes. Each step is an aggregate and a join; a hub's links are never in one place but
    as sums. What a step made is written to the shared checkpoint folder, so that the lineage stays short.
    """
    edges = cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    while True:
        # large star: links to larger neighbours move to the smallest neighbour (or the node itself)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        # small star: links to smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        new = cut(small.where("u != v").distinct())
        tops = new.select(F.col("v").alias("u")).distinct()
        if new.join(tops, "u", "left_semi").isEmpty() and new.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        edges = new
