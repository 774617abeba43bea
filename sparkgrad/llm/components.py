"""Connected components of a graph given as edges, by alternating large and small stars.

Every round rewires the edges towards the smallest node seen so far; the number of rounds grows with the
logarithm of the longest chain. A round is joins and grouped minima, so a node with a third of
all edges is a partial aggregate and a join that Spark can split. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgrad.session import materialize


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it. Edges (u, v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them. Edges (u, v) with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return tied.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node it can reach.

    ``edges``: two columns u, v of one orderable type; loops and NULLs are ignored, directions and repeats don't matter.
    """
    state = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before, found = None, state(now)
    while found[0] and found != before:
        now = materialize(small_star(large_star(now)), "edges")
        before, found = found, state(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
