"""Connected groups of an edge table, by alternating star contraction.

Each round hangs every node's larger neighbours on its smallest one, then its smaller ones. Both
are an aggregation and a join, so no task holds a node's neighbours; the edges of a round are
written, and the rounds end when the edges no longer change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.runtime import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")).toDF("a", "b"))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(lowest, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(lowest, "a").where("b > m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(lowest.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``a, b`` edges: the smallest node of its group. Edges
    may repeat, point either way, or join a node to itself; nulls are dropped."""
    edges = cut_lineage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        edges = cut_lineage(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
