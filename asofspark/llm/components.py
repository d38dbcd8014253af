"""Connected components of an edge list by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm.common import written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to the smallest node it sees."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (both.join(least, F.col("a") == F.col("u")).where("b > a")
            .select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node sends its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    kids = (down.join(least, F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return kids.union(own).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``; the label is the component's least node.

    Every round is two grouped joins over the edges; rounds grow with the logarithm of the
    longest path. Each round is written to the shared folder, so the plan stays short and a
    lost executor does not replay earlier rounds. Stops when a round changes nothing: then every
    edge points from a node straight to its component's least node.
    """
    now = written(spark, edges.select("a", "b").where("a <> b")
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "edges")
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        now = written(spark, _small_star(_large_star(now)), "edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return nodes.union(roots)
