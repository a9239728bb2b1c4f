"""Exact quantiles of whole columns in two scans.

A mergeable sketch brackets every wanted rank between two values of the column;
then the values inside the brackets are counted, and those below. Tasks add up
what they read; what is counted one by one is a small share of the values, set
by the sketch's accuracy, and equal values are one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The sketch's ranks are within a share of 1 / ACCURACY of the rows.
ACCURACY = 10_000


def _finite(column: str) -> Column:
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float], accuracy: int = ACCURACY) -> dict[str, list[float | None]]:
    """For each column its quantiles at `shares`, linear between neighbours; null
    and non-finite values are left out, a column without values has None."""
    if not columns or not shares:
        return {c: [None] * len(shares) for c in columns}
    values = df.select(*[_finite(c).alias(f"v{i}") for i, c in enumerate(columns)])
    slack, found = 2.0 / accuracy, {}
    while True:
        marks = [min(1.0, max(0.0, q + s)) for q in shares for s in (-slack, slack)]
        one = values.agg(*[x for i in range(len(columns)) for x in (F.count(f"v{i}").alias(f"n{i}"), F.min(f"v{i}").alias(f"lo{i}"), F.max(f"v{i}").alias(f"hi{i}"), F.percentile_approx(f"v{i}", marks, accuracy).alias(f"q{i}"))]).first()
        wanted, brackets = [], []
        for i in range(len(columns)):
            n = one[f"n{i}"]
            for k, q in enumerate(shares) if n else ():
                ranks = {math.floor((n - 1) * q), math.ceil((n - 1) * q)}
                low = one[f"lo{i}"] if marks[2 * k] == 0 else one[f"q{i}"][2 * k]
                high = one[f"hi{i}"] if marks[2 * k + 1] == 1 else one[f"q{i}"][2 * k + 1]
                brackets.append((i, low, high))
                wanted += [(len(brackets) - 1, r) for r in ranks if (i, r) not in found]
        if not wanted:
            break
        part = lambda b, i, low, high: F.when(F.col(f"v{i}") <= high, F.struct(F.lit(b).alias("b"), F.when(F.col(f"v{i}") >= low, F.col(f"v{i}")).alias("v")))
        rows = values.select(F.explode(F.array_compact(F.array(*[part(b, *x) for b, x in enumerate(brackets)]))).alias("x"))
        counts = rows.groupBy("x.b", "x.v").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("b").orderBy(F.asc_nulls_first("v")))  # those below the bracket come first
        hits = F.explode(F.filter(F.array(*[F.struct(F.lit(b).alias("b"), F.lit(r).cast("long").alias("rank")) for b, r in wanted]), lambda w: (w["b"] == F.col("b")) & (w["rank"] < F.col("upto")) & (w["rank"] >= F.col("upto") - F.col("n"))))
        got = counts.withColumn("upto", upto).where("v is not null").select("b", "v", hits.alias("hit")).select("b", "v", "hit.rank").collect()  # a row for each rank
        found |= {(brackets[r["b"]][0], r["rank"]): r["v"] for r in got}
        if all((brackets[b][0], r) in found for b, r in wanted):
            break
        slack *= 8  # a sketch that was further off than it should
    out = {}
    for i, c in enumerate(columns):
        n, own = one[f"n{i}"], []
        for q in shares:
            if not n:
                own.append(None)
                continue
            at = (n - 1) * q
            a, b = found[i, math.floor(at)], found[i, math.ceil(at)]
            own.append(a + (b - a) * (at - math.floor(at)))
        out[c] = own
    return out
