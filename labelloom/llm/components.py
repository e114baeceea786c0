"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.shared import attach
from labelloom.operators.pin import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``edges``, rows ``a, b`` of longs; a component is named by its least node.

    Each round hangs every node's larger neighbours, then its smaller ones, on
    the least node it knows of; the number of rounds grows with the logarithm of
    the longest chain. A node with very many neighbours is looked up by
    broadcast, see :func:`attach`. Every round is written to the shared folder.
    """
    stars, mark = settle(_ordered(edges)), None
    while (now := stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()) != mark:
        mark = now
        both = settle(stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        large = settle(_ordered(_to_least(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))))
        known = _to_least(large)
        smaller = known.select(F.col("b").alias("a"), F.col("least").alias("b"))
        own = known.select("a", F.col("least").alias("b"))
        stars = settle(_ordered(smaller.unionByName(own)))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, the larger node first."""
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ends.where("a > b").distinct()


def _to_least(edges: DataFrame) -> DataFrame:
    """``edges`` with the least node among ``a`` and its neighbours."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"), F.count(F.lit(1)).alias("n"))
    return attach(edges, settle(least), "a", "n", edges.count())
