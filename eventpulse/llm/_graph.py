"""Connected components by star contraction, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventpulse.llm._common import saved


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with an edge ``(a, b)``: the smallest node it reaches.

    The root itself is listed too. Rounds of large and small stars lead every node to its
    smallest neighbour until nothing changes; a round groups by node and keeps minima only, so
    a node with very many neighbours is combined before the shuffle. Their number grows with the
    logarithm of the longest path.
    """
    stars = saved(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    seen = None
    while (state := _state(stars)) != seen:
        seen = state
        stars = saved(_small_star(_large_star(stars)), "stars")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours go to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    # A node whose smallest neighbour is larger is a centre already; its edges stay as they are.
    moved = both.where("v > u").join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
