"""The pigeonring condition as a column: of segments in a ring whose differences
add up to at most a budget, one begins a chain of which every part stays within
its proportional share of the budget."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Bits in which linked fingerprints may differ: dense segments are covered by
#: points one bit away, which is exact for two.
DISTANCE = 2
#: A segment's value with more fingerprints than this is not paired up.
DENSE = 16


def chain_from(start: int, differences: list[Column], budget: Column, length: int) -> Column:
    """Whether the chain of `length` segments from `start` on is within its shares."""
    m, total, ok = len(differences), F.lit(0), []
    for l in range(1, length + 1):
        total = total + differences[(start + l - 1) % m]
        ok.append(total * m <= budget * l)
    return reduce(lambda a, b: a & b, ok)


def has_chain(differences: list[Column], budget: Column, length: int | None = None) -> Column:
    """Whether any segment begins such a chain (of all segments by default).
    Never false where the differences add up to the budget or less."""
    m = len(differences)
    return reduce(lambda a, b: a | b, (chain_from(i, differences, budget, length or m) for i in range(m)))


def _segments(distance: int) -> list[int]:
    """Masks of distance + 1 segments of 64 bits, as signed longs."""
    cuts = np.linspace(0, 64, distance + 2).round().astype(int)
    masks = [((1 << int(z - a)) - 1) << int(a) for a, z in zip(cuts[:-1], cuts[1:])]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def hamming_links(reps: DataFrame, dense: int = DENSE) -> DataFrame:
    """Links (a, b) that connect every two rows of reps (node, fp; fp distinct)
    whose fingerprints differ in at most DISTANCE bits.

    A segment value that at most `dense` fingerprints share is paired up, under
    the chain condition. Denser values would give pairs with the square of
    their size; there every fingerprint is written at the points
    one bit away from it that keep the segment. Two fingerprints differ in at
    most two bits outside it exactly if they share such a point, and no point
    has more than 65 fingerprints; each point links its fingerprints in a star.
    """
    masks = _segments(DISTANCE)
    n = len(masks)
    keyed = reps.select("node", "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), F.col("fp").bitwiseAND(F.lit(m)).alias("val")) for i, m in enumerate(masks)])).alias("k")).select("node", "fp", "k.seg", "k.val")
    crowd = keyed.groupBy("seg", "val").count().where("count > 1")
    keyed = C.materialise(keyed.join(crowd, ["seg", "val"]), "segments")
    small, large = keyed.where(F.col("count") <= dense), keyed.where(F.col("count") > dense)
    x = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    run, chain = None, F.lit(True)
    for length in range(2, n + 1):
        # the run of `length` segments from seg on differs in length - 1 bits at most
        run = F.element_at(F.array(*[F.lit(np.bitwise_or.reduce([np.int64(masks[(i + j) % n]) for j in range(length)]).item()) for i in range(n)]), F.col("l.seg") + 1)
        chain = chain & (F.bit_count(x.bitwiseAND(run)) <= length - 1)
    pairs = (
        small.alias("l").join(small.alias("r"), (F.col("l.seg") == F.col("r.seg")) & (F.col("l.val") == F.col("r.val")) & (F.col("l.fp") < F.col("r.fp")) & chain)
        .where(F.bit_count(x) <= DISTANCE)
        .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
    )
    flips = F.array(*[F.lit(0).cast("long")], *[F.lit((1 << j) - (1 << 64) if j == 63 else 1 << j).cast("long") for j in range(64)])
    outside = F.filter(flips, lambda b: b.bitwiseAND(F.element_at(F.array(*[F.lit(m) for m in masks]), F.col("seg") + 1)) == 0)
    points = large.select("node", F.explode(F.transform(outside, lambda b: b.bitwiseXOR(F.col("fp")))).alias("point"))
    stars = points.groupBy("point").agg(F.collect_set("node").alias("nodes")).where(F.size("nodes") > 1)
    stars = stars.select(F.array_min("nodes").alias("a"), F.explode("nodes").alias("b")).where("a != b")
    return pairs.unionByName(stars).distinct()
