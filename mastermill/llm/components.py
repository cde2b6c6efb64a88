"""Connected components of links between whole numbers, by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame, label: str = "stars") -> DataFrame:
    """``node`` and ``root`` (the smallest node that can be reached) of every node of ``links`` (``a``, ``b``) but the roots.

    Large-star links each greater neighbour of a node to the smallest of its neighbourhood, small-star each smaller
    one; after a number of rounds that grows with the logarithm of the input only stars are left. Each round is written to the
    shared folder, so neither the plan nor the loss of an executor grows with the rounds. The driver sees two sums per round.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges, before = stored(edges, label), None
    while (now := _sums(edges)) != before:
        edges, before = stored(_small_star(_large_star(edges)), label), now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _sums(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", "m")).distinct()
