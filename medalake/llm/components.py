"""Connected components of a graph given as edges, by alternating star contractions in Spark.

Every round is two shuffles of the edge list; the number of rounds grows with the logarithm of the longest path.
A node with very many neighbours costs one row per neighbour, never a pair of neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalake.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's neighbours (the larger ones, or else the smaller ones and itself) to its smallest."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # the smallest neighbour by a partial aggregate and a join back: a hub's rows needn't meet in one task
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    out = joined.where(F.col("b") > F.col("a")) if large else joined.where(F.col("b") != F.col("m"))
    linked = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        linked = linked.union(least.select("a", F.col("m").alias("b")))
    return linked.where("a != b").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component): for every node of an edge (a, b), the smallest node that it is connected to."""
    now = saved(edges.select("a", "b").where("a != b").distinct(), spark, "cc")
    stamp = None
    while True:
        now = saved(_star(_star(now, True), False), spark, "cc")
        # stable when every edge leads from a node to its component's smallest one, and nothing moved
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == stamp:
            break
        stamp = mark
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
