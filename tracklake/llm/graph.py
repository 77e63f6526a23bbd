"""Connected components by large and small stars, in DataFrame joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.session import stage


def _large(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours are tied to the least node it knows, itself included."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    tied = both.where("b > a").join(least, F.col("a") == F.col("n"))
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    tied = edges.join(least, F.col("a") == F.col("n"))
    lesser = tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lesser.union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b); a component is named by its least node.

    Rounds grow with the logarithm of the longest path. A hot node is a skewed join, which
    adaptive execution splits; groups are never gathered.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, seen = stage(now, "edges"), None
    while True:
        now = stage(_small(_large(now)), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
