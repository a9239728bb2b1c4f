"""Personal-baseline anomaly flags and an isolation forest."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise
from .features import recent_rows, user_line
from .quantiles import exact_quantiles

# The watched measurements and their least scales.
FLOORS = {"hrv_rmssd_milli": 1.0, "resting_heart_rate": 1.0, "skin_temp_celsius": 0.05, "respiratory_rate": 0.1}


def _middle(sorted_values: Column) -> Column:
    """Median of a sorted array without nulls; null if it is empty."""
    n = F.size(sorted_values)
    at = lambda i: F.get(sorted_values, F.floor(i).cast("int"))
    return F.when(n > 0, (at(n / 2) + at((n - 1) / 2)) / 2.0)


def robust_scores(history: DataFrame, window: int = 28, least: int = 14, k: float = 3.5, floors: dict[str, float] | None = None) -> DataFrame:
    """z of each watched column against the median and MAD of the user's cycles
    before it (`window` of them; null with fewer than `least` values), and
    is_anomaly: any z above k. A row never takes part in its own baseline, and
    the arrays hold `window` values at most."""
    if not 2 <= least <= window or k <= 0:
        raise ValueError("invalid baseline")
    floors = FLOORS if floors is None else floors
    before = user_line().rowsBetween(-window, -1)
    out = history.withColumns({f"__w_{c}": F.sort_array(F.collect_list(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).over(before)) for c in floors})
    out = out.withColumns({f"__m_{c}": _middle(F.col(f"__w_{c}")) for c in floors})
    away = lambda c: F.transform(f"__w_{c}", lambda x: F.abs(x - F.col(f"__m_{c}")))
    out = out.withColumns({f"__d_{c}": _middle(F.sort_array(away(c))) for c in floors})
    z = {f"z_{c}": F.when(F.size(f"__w_{c}") >= least, F.abs(F.col(c) - F.col(f"__m_{c}")) / F.greatest(F.lit(1.4826) * F.col(f"__d_{c}"), F.lit(floor))) for c, floor in floors.items()}
    out = out.withColumns(z)
    flag = F.lit(False)
    for name in z:
        flag = flag | F.coalesce(F.col(name) > k, F.lit(False))
    return out.withColumn("is_anomaly", flag).drop(*[f"__{p}_{c}" for p in "wmd" for c in floors])


def score_new(fitted: DataFrame, new: DataFrame, window: int = 28, **options) -> DataFrame:
    """robust_scores of new rows after the tail of a fitted history."""
    tail = recent_rows(fitted, window).select(*new.columns).withColumn("__new", F.lit(False))
    both = tail.unionByName(new.withColumn("__new", F.lit(True)))
    return robust_scores(both, window, **options).where("__new").drop("__new")


def flag_rate(tested: DataFrame) -> DataFrame:
    """Share of flagged test rows (is_anomaly) of each user's folds."""
    return tested.groupBy("user_id", "fold").agg(F.avg(F.col("is_anomaly").cast("double")).alias("flag_rate"), F.count("*").alias("evaluated_rows"))


# ---------------------------------------------------------------- forest
#: A node of a tree: the value it asks for, the cut, where the two sides are (in
#: the tree's array), and at a leaf (feature -1) its path length.
NODE = "struct<feature:int,cut:double,low:int,high:int,length:double>"


def _tree(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """The nodes of a random tree over rows x, the root first."""
    nodes: list = []

    def grow(x: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(None)
        spread = np.flatnonzero(x.max(0) > x.min(0)) if len(x) else np.zeros(0, int)
        if depth >= limit or len(x) < 2 or not len(spread):
            nodes[at] = (-1, 0.0, 0, 0, depth + _expected(len(x)))
            return at
        f = int(rng.choice(spread))
        cut = float(rng.uniform(x[:, f].min(), x[:, f].max()))
        low = x[:, f] < cut
        a = grow(x[low], depth + 1)
        nodes[at] = (f, cut, a, grow(x[~low], depth + 1), 0.0)
        return at

    grow(x, 0)
    return nodes


def _expected(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 2 * (float(np.log(n - 1)) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def grow_forest(narrow: DataFrame, keys: list[str], columns: list[str], trees: int, rows: int, seed: int) -> DataFrame:
    """(tree, n, nodes): each tree grows in a task of its own from about `rows`
    rows that a hash picks, so that no part of the ids is preferred."""
    share = min(1.0, rows / max(1, narrow.count()))
    draw = lambda t: F.pmod(F.xxhash64(t, F.lit(seed), *keys), F.lit(1_000_003))
    draws = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < share * 1_000_003)
    sample = narrow.select(F.explode(draws).alias("tree"), *keys, *columns).withColumn("__draw", draw(F.col("tree")))
    limit = int(np.ceil(np.log2(max(rows, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        x = pdf.sort_values(["__draw", *keys])[columns].to_numpy()[: 2 * rows]
        names = ("feature", "cut", "low", "high", "length")
        return pd.DataFrame({"tree": [t], "n": [len(x)], "nodes": [[dict(zip(names, n)) for n in _tree(x, np.random.default_rng(seed * 1000 + t), limit)]]})

    return sample.groupBy("tree").applyInPandas(grow, f"tree int, n int, nodes array<{NODE}>")


def path_length(nodes: Column, x: Column, limit: int) -> Column:
    """How deep the values x (an array) fall in a tree."""

    def down(at: Column, _: Column) -> Column:
        node = F.get(nodes, at)
        return F.when(node["feature"] < 0, at).when(F.get(x, node["feature"]) < node["cut"], node["low"]).otherwise(node["high"])

    return F.get(nodes, F.aggregate(F.sequence(F.lit(1), F.lit(limit)), F.lit(0), down))["length"]


def path_lengths(trees: list, x: np.ndarray, limit: int) -> np.ndarray:
    """The sum over the trees (node arrays: feature, cut, low, high, length) of
    how deep each row of x falls."""
    total, row = np.zeros(len(x)), np.arange(len(x))
    for feature, cut, low, high, length in trees:
        at = np.zeros(len(x), np.int64)
        for _ in range(limit):
            f = feature[at]
            at = np.where(f < 0, at, np.where(x[row, f] < cut[at], low[at], high[at]))
        total += length[at]
    return total


def isolation_forest(history: DataFrame, columns: list[str] | None = None, trees: int = 100, rows: int = 256, contamination: float = 0.03, seed: int = 42) -> DataFrame:
    """history with isolation_score (higher: lonelier) and is_isolated: above
    the 1 - contamination quantile. The forest (trees * 4 * rows nodes at most)
    is one broadcast row, and a column expression walks it; the scored rows are
    written once. Nulls count as the column's median."""
    columns = list(FLOORS) if columns is None else columns
    keys = ["user_id", "cycle_id"]
    names = [f"__{c}" for c in columns]
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    history = materialise(history, "measured")
    narrow = history.select(*keys, *[value(c).alias(n) for c, n in zip(columns, names)])
    medians = exact_quantiles(narrow, names, [0.5])
    fill = lambda c, n: F.coalesce(c, F.lit(medians[n][0] or 0.0))
    filled = narrow.select(*keys, *[fill(F.col(n), n).alias(n) for n in names])
    grown = materialise(grow_forest(filled, keys, names, trees, rows, seed), "trees")
    forest = grown.orderBy("tree").collect()  # trees * 4 * rows nodes at most
    norm = float(_expected(sum(r["n"] for r in forest) / len(forest) if forest else 2)) or 1.0
    arrays = [tuple(np.array(v) for v in zip(*r["nodes"])) for r in forest]
    shared = history.sparkSession.sparkContext.broadcast(arrays)
    limit = int(np.ceil(np.log2(max(rows, 2))))

    @F.pandas_udf("double")
    def depth(*x: pd.Series) -> pd.Series:
        return pd.Series(path_lengths(shared.value, np.column_stack([c.to_numpy(np.float64) for c in x]), limit))

    x = [fill(value(c), n) for c, n in zip(columns, names)]
    # the walk is the work here, so small tables are spread over all cores as well
    spread = history.repartition(int(history.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    score = F.pow(F.lit(2.0), -(depth(*x) / F.lit(len(forest))) / F.lit(norm)) if forest else F.lit(1.0)
    scored = spread.withColumn("isolation_score", score)
    scored = materialise(scored, "isolation")
    cut = exact_quantiles(scored, ["isolation_score"], [1 - contamination])["isolation_score"][0]
    return scored.withColumn("is_isolated", F.coalesce(F.col("isolation_score") > F.lit(cut).cast("double"), F.lit(False)))
