"""Connected components of an edge table by alternating large-star and small-star rounds.

Each half round is two joins or groupings over the edges; nothing is collected but one checksum a
round. Edges and minima are staged in the shared folder, which cuts the lineage and lets the joins
be split where one node has very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.plans.staging import drop_staged, stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("a"), F.col("v").alias("b")),
        F.struct(F.col("v").alias("a"), F.col("u").alias("b")))).alias("e")).select("e.*")


def _star(pairs: DataFrame, smaller: bool) -> DataFrame:
    """Link the larger neighbours (or, with ``smaller``, the smaller ones) of each node to its
    least neighbour or itself."""
    near = pairs.where(F.col("b") < F.col("a")) if smaller else pairs
    least = stage(near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    moved = near if smaller else near.where(F.col("b") > F.col("a"))
    linked = moved.join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
    if smaller:
        linked = linked.union(least.select(F.col("a").alias("u"), F.col("m").alias("v")))
    out = stage(linked.where(F.col("u") != F.col("v")).distinct(), "edges")
    drop_staged(least)
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v), component being its least node.

    Loops are dropped, repeated and reversed edges don't matter, and edges with a null end are left
    out. No edges give an empty result.
    """
    edges = stage(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    checksum = None
    while True:
        found = edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if found == checksum:
            break
        checksum = found
        large = _star(_both_ways(edges), smaller=False)
        drop_staged(edges)
        edges = _star(_both_ways(large), smaller=True)
        drop_staged(large)
    least = edges.groupBy(F.col("v").alias("node")).agg(F.min("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(least)
