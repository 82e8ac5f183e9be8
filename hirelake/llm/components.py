"""Connected components of a graph of numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected edges ``(u, v)``; root is its smallest node.

    Large-star and small-star steps alternate until the edges are stars around the roots; the number
    of rounds grows with the logarithm of the longest path. Neighbours are only ever reduced by ``min``,
    which is done before the shuffle, and joins that meet a hot node are split by AQE. Self-links and
    repeated edges do no harm; a node that has only a self-link is left out, as is a NULL.
    """
    oriented = edges.where("u <> v").select(
        F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")
    )
    edges, before = stored(oriented.distinct(), "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == before or not state["n"]:
            break
        before = state
        edges = stored(_small_star(_large_star(edges)), "edges")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())
