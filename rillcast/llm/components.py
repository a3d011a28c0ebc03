"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillcast.sources.staged import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; long): root is the smallest node reachable.

    Alternating star contraction: each round hangs every node's larger
    neighbours, then its smaller ones, on the smallest neighbour; the number
    of rounds grows with the logarithm of the largest component. A round is
    two minima (partial before the shuffle) and two joins; its edges are
    written to the shared folder, so no round depends on older ones. Loops,
    repeated edges and either direction are fine; an empty table gives none.
    """
    now = stage(pointed(edges.where("a <> b")))
    before = None
    while (size := signature(now)) != before:
        before = size
        now = stage(smaller_star(larger_star(now)))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()


def pointed(edges: DataFrame) -> DataFrame:
    """Edges (u, v) from the larger to the smaller node, each once."""
    return edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def larger_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").transform(pointed)


def smaller_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").transform(pointed)
