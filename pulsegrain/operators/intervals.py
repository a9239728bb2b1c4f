"""Forecast intervals by moving-block bootstrap of out-of-sample residuals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clipped


def hashed_start(seed: int) -> Callable[[Column, Column, Column], Column]:
    """Start of a block: (replicate, block, places) -> 0 .. places - 1."""
    return lambda replicate, block, places: F.pmod(F.xxhash64(F.lit(seed), replicate, block), places)


def _quantile(sorted_values: Column, n: Column, q: float) -> Column:
    """Linear between neighbours, of a sorted array of n values."""
    at = (n - 1) * F.lit(q)
    lo = F.floor(at).cast("int")
    a, b = F.get(sorted_values, lo), F.get(sorted_values, F.least(lo + 1, n - 1))
    return a + (b - a) * (at - lo)


def bootstrap_tails(residuals: DataFrame, order: list[str], confidence: float = 0.9, replicates: int = 1000, block: int = 7, start: Callable | None = None, seed: int = 42) -> DataFrame:
    """(user_id, n, low_tail, high_tail): mean tail quantiles over replicates
    that redraw each user's residuals (user_id, residual, order columns) in
    runs of `block`. Users with fewer than max(20, block) residuals, or with one
    that is not finite, have no row. Replicates are arrays within the user's one row."""
    if not 0 < confidence < 1 or replicates < 100 or block < 1:
        raise ValueError("invalid bootstrap")
    start = hashed_start(seed) if start is None else start
    r = F.col("residual").cast("double")
    series = residuals.groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct(*order, r.alias("r")))), lambda x: x["r"]).alias("r"), F.bool_and(r.isNotNull() & ~F.isnan(r) & (F.abs(r) != float("inf"))).alias("ok"))
    series = series.where("ok").withColumn("n", F.size("r")).where(F.col("n") >= max(20, block))
    blocks = F.sequence(F.lit(0), F.ceil(F.col("n") / block).cast("int") - 1)
    tail = (1 - confidence) / 2

    def ends(replicate: Column) -> Column:
        drawn = F.flatten(F.transform(blocks, lambda b: F.slice("r", (start(replicate, b, F.col("n") - block + 1) + 1).cast("int"), block)))
        # a one-element array names the sorted draw, so that it is made once
        once = F.array(F.sort_array(F.slice(drawn, F.lit(1), F.col("n"))))
        return F.get(F.transform(once, lambda s: F.struct(_quantile(s, F.col("n"), tail).alias("lo"), _quantile(s, F.col("n"), 1 - tail).alias("hi"))), F.lit(0))

    one = series.select("user_id", "n", F.transform(F.sequence(F.lit(0), F.lit(replicates - 1)), ends).alias("e"))
    mean = lambda k: F.aggregate("e", F.lit(0.0), lambda a, x: a + x[k]) / replicates
    return one.select("user_id", "n", mean("lo").alias("low_tail"), mean("hi").alias("high_tail"))


def prediction_intervals(predictions: DataFrame, tails: DataFrame) -> DataFrame:
    """predictions (user_id, predicted) with ci_lower and ci_upper in [0, 100]."""
    out = predictions.join(tails.select("user_id", "low_tail", "high_tail"), "user_id")
    return out.withColumns({"ci_lower": clipped(F.col("predicted") + F.col("low_tail")), "ci_upper": clipped(F.col("predicted") + F.col("high_tail"))}).drop("low_tail", "high_tail")
