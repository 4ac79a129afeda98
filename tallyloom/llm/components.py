"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.common import sized, stored


def _print(edges: DataFrame):
    """Count and order-free checksum of the edges; equal twice in a row means that nothing moved."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def _to_least(edges: DataFrame, split: bool) -> DataFrame:
    """Per ``u`` the least ``v``. ``split``: stored, so that both sides of the next join are plain shuffles, whose hot
    keys adaptive execution splits."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return stored(least, "least") if split else least


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node of its component) for every node that has an edge in ``edges`` (``u``, ``v``).

    Large-star hooks each node's larger neighbours to the least one it knows, small-star the smaller ones; the
    rounds grow with the logarithm of the longest path. A node's neighbours are never gathered: a minimum per
    node, combined before the shuffle, and one join back. Each step is a written table, not a checkpoint: a
    checkpoint keeps the partitions it was made with, and unions of them add up from round to round. Edges that
    fit one task stay in one. Self-loops, repeated edges and edges with a null end change nothing; no edges give no
    rows.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = sized(stored(edges.distinct(), "edges"))
    before = None
    while (now := _print(edges)) != before:
        before = now
        split = edges.rdd.getNumPartitions() > 1
        ends = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
        both = edges.select(ends.alias("e")).select("e.u", "e.v")
        least = _to_least(both, split).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star") if split else large
        least = _to_least(large, split)
        # Every node hooks to its least neighbour, and so do its other neighbours.
        hooks = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        hooked = large.join(least, "u").select(F.explode(hooks).alias("e")).select("e.u", "e.v").filter("u <> v")
        edges = sized(stored(hooked.distinct(), "small-star"))
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("root")), F.struct(F.col("v").alias("node"), F.col("v").alias("root"))))
    return edges.select(ends.alias("e")).select("e.node", "e.root").distinct()
