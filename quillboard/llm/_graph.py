"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillboard.llm._scratch import Scratch


def _undirected(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node it knows."""
    both = _undirected(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    sideways = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return sideways.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    ``edges`` has long columns u and v; self loops and repeats are allowed and a
    null end is no edge. Each round is two joins on the edge table and is written
    to the shared folder; the rounds grow with the logarithm of the longest path.
    """
    edges = scratch.table(f"{name}-0", edges.where("u != v").select("u", "v").distinct())
    seen, turn = None, 0
    while True:
        turn += 1
        edges = scratch.table(f"{name}-{turn}", _small_star(_large_star(edges)))
        scratch.drop(f"{name}-{turn - 1}")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
