"""Connected components of a graph of 64-bit nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.scratch import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root`` for each node of the edges ``a``, ``b`` (two longs): the smallest node
    that it is connected to. Repeated edges and loops do no harm; nodes without an edge are not listed.

    Each round hangs the larger neighbours of a node, then the smaller ones, on the smallest; the
    number of rounds grows with the logarithm of the number of nodes. A node with very many
    neighbours is an aggregate and a join, never one list. Rounds are written to scratch, and the
    last one is a star around each root.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = settle(edges.where("a <> b").select(larger, smaller).distinct())
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        hung = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lower = hung.groupBy("a").agg(F.min("b").alias("m"))
        moved = hung.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = settle(moved.unionByName(lower.select("a", F.col("m").alias("b"))).distinct())
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of a set of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
