"""Connected components of a graph of links, by alternating large-star and
small-star steps: a logarithmic number of rounds, edges only, no driver state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One step. edges: u > v, distinct. A node's neighbours are linked to the
    smallest of them (large: neighbours above it; small: those below it)."""
    if small:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of `links` (columns a, b; any order,
    repeats and self-links allowed, nulls ignored); the component is its
    smallest node. Nodes without a link are absent."""
    edges = links.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(edges, "links")
    mark = None
    for _ in range(max_rounds):
        edges = materialise(_stars(_stars(edges, small=False), small=True), "stars")
        now = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
