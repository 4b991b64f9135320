"""Connected components by star contraction: no group of neighbours is ever collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellmart.llm.common import stored


# edges of which a single task can hold those of one hub
HUB = 1 << 20


def _mark(edges: DataFrame) -> tuple:
    """Tells whether two sets of edges are the same, from one row."""
    mixed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(mixed.bitwiseAND(F.lit(0xFFFFFF)))).first())


def connected(edges: DataFrame) -> DataFrame:
    """Edges ``(u, v)`` of longs to stars: one row ``(node, root)`` per node other than a root.

    Alternates two contractions until nothing changes. Each is a minimum per node (summed in the
    scan tasks) and a join back, so a hub's neighbours are never together in one row. Among more than ``HUB`` edges the
    minima are stored before the join, which then is one of two tables: Spark splits a hot hub only in those.
    The number of rounds grows with the logarithm of the longest path. Loops are ignored; an
    empty table gives an empty result.
    """
    larger, smaller = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = stored(edges.where("u <> v").select(larger, smaller).distinct(), "edges")
    before, now = None, _mark(edges)
    while now != before:
        kept = stored if now[0] > HUB else (lambda df, _: df)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = kept(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low")), "lowest")
        # every larger neighbour to the node's lowest
        edges = kept(both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "raised")
        lowest = kept(edges.groupBy("u").agg(F.min("v").alias("low")), "lowest")
        # every smaller neighbour, and the node, to the lowest
        moved = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v")
        edges = stored(moved.unionByName(lowest.select("u", F.col("low").alias("v"))).distinct(), "edges")
        before, now = now, _mark(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
