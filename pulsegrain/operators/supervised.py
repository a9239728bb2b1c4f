"""Next-cycle training pairs, history checks, walk-forward folds and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .contracts import outside
from .features import FEATURES, user_line

LOW_RECOVERY = 33.0


def history_violations(history: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """(rule, violations) of a model history: identity present, cycle ids and
    start times unique for each user, no infinities, scores within 0 to 100.
    Only broken rules have rows; a missing column is a rule of its own."""
    need = ["cycle_id", "user_id", "start_at", *features]
    if missing := [c for c in need if c not in history.columns]:
        return history.sparkSession.createDataFrame([(f"missing_column:{c}", 1) for c in missing], "rule string, violations bigint")
    rules = {f"null:{c}": F.col(c).isNull() for c in need[:3]}
    rules |= {f"infinite:{c}": F.coalesce(F.abs(F.col(c).cast("double")) == float("inf"), F.lit(False)) for c in features}
    rules["range:recovery_score"] = outside(F.col("recovery_score"), 0.0, 100.0)
    one = history.agg(*[F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    found = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations")) for i, n in enumerate(rules)])).alias("x")).select("x.*")
    twice = [history.groupBy("user_id", c).count().where("count > 1").agg(F.lit(f"duplicate:{c}").alias("rule"), F.count("*").alias("violations")) for c in ("cycle_id", "start_at")]
    return reduce(DataFrame.unionByName, [found, *twice]).where("violations > 0")


def supervised_pairs(history: DataFrame) -> DataFrame:
    """history with target (the next cycle's recovery), low_recovery, and the
    next cycle's id and start; pairs without a known target are dropped after
    pairing, so a pending cycle is never skipped over."""
    w = user_line()
    out = history.withColumns({"target": F.lead("recovery_score").over(w).cast("double"), "target_cycle_id": F.lead("cycle_id").over(w), "target_start_at": F.lead("start_at").over(w)})
    return out.where("target is not null").withColumn("low_recovery", (F.col("target") <= LOW_RECOVERY).cast("int"))


def readiness(pairs: DataFrame, min_pairs: int = 90, min_days: int = 89) -> DataFrame:
    """Pairs, days covered and whether each user has enough of both."""
    span = (F.unix_micros(F.max("target_start_at").cast("timestamp")) - F.unix_micros(F.min("start_at").cast("timestamp"))) / F.lit(86400e6)
    out = pairs.groupBy("user_id").agg(F.count("*").alias("pairs"), span.alias("days"))
    return out.withColumn("ready", (F.col("pairs") >= min_pairs) & (F.col("days") >= min_days))


def regression_metrics(df: DataFrame, keys: list[str], actual: str = "target", predicted: str = "predicted") -> DataFrame:
    """mae, r2, mape over non-zero actuals (null without any) and how many
    zeros were left out. A constant target has r2 1 if all errors are 0, else 0."""
    a, e = F.col(actual).cast("double"), F.col(predicted).cast("double") - F.col(actual).cast("double")
    one = df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("__ss"), (F.count(a) * F.var_pop(a)).alias("__tot"), F.min(a).alias("__lo"), F.max(a).alias("__hi"),
        (F.avg(F.when(a != 0, F.abs(e / F.when(a != 0, a)))) * 100).alias("mape"), F.count_if(a == 0).alias("mape_excluded_zeros"),
    )
    r2 = F.when(F.col("__lo") == F.col("__hi"), F.when(F.col("__ss") == 0, 1.0).otherwise(0.0)).otherwise(1 - F.col("__ss") / F.when(F.col("__tot") > 0, F.col("__tot")))
    return one.withColumn("r2", r2).drop("__ss", "__tot", "__lo", "__hi")


def classification_metrics(df: DataFrame, keys: list[str], actual: str = "low_recovery", probability: str = "probability") -> DataFrame:
    """precision and recall at 0.5 (0 where undefined), positive_count, and auc
    by mean ranks (null unless both classes are there)."""
    y, hit = F.col(actual) == 1, F.col(probability) >= 0.5
    safe = lambda a, b: F.when(b > 0, a / F.when(b > 0, b)).otherwise(F.lit(0.0))
    ranked = df.withColumn("__low", F.rank().over(Window.partitionBy(*keys).orderBy(probability)))
    same = Window.partitionBy(*keys, probability)
    ranked = ranked.withColumn("__rank", F.col("__low") + (F.count("*").over(same) - 1) / 2.0)
    one = ranked.groupBy(*keys).agg(F.count_if(y & hit).alias("__tp"), F.count_if(hit).alias("__p"), F.count_if(y).alias("positive_count"), F.count("*").alias("__n"), F.sum(F.when(y, F.col("__rank"))).alias("__ranks"))
    pos, neg = F.col("positive_count"), F.col("__n") - F.col("positive_count")
    auc = F.when((pos > 0) & (neg > 0), (F.col("__ranks") - pos * (pos + 1) / 2.0) / F.when((pos > 0) & (neg > 0), pos * neg))
    return one.select(*keys, safe(F.col("__tp"), F.col("__p")).alias("precision"), safe(F.col("__tp"), pos).alias("recall"), "positive_count", auc.alias("auc"))


def metrics_long(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """Wide metrics as (keys, metric, value), absent values left out."""
    names = [c for c in metrics.columns if c not in keys]
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    return metrics.select(*keys, F.explode(rows).alias("x")).select(*keys, "x.*").where("value is not null")


def metric_summary(long: DataFrame, keys: list[str]) -> DataFrame:
    """Mean, population deviation and contributing folds of each metric."""
    return long.groupBy(*keys, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("*").alias("folds"))


def error_by(df: DataFrame, key: Column, actual: str = "target", predicted: str = "predicted") -> DataFrame:
    """Mean signed and absolute error by a key, such as the weekday."""
    e = F.col(predicted) - F.col(actual)
    return df.groupBy(key).agg(F.avg(e).alias("bias"), F.avg(F.abs(e)).alias("mae"), F.count("*").alias("n"))
