"""Silver tables derived from the driver's tables.

events give cycles (a user's day), recovery (clicks), sleep (views) and
workouts (purchases); orders by nation and date give a long daily history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.flatten import conform
from ..operators.folds import fold_rows
from ..operators.supervised import supervised_pairs


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    return e.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value", k.alias("k"), (F.col("user_id") * 1000 + day).alias("cycle_id"))


def _scored(c, value):
    return F.when(c % 10 < 8, value)


def silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """cycles, recovery, sleep and workouts with all silver columns; those that
    events cannot fill are null."""
    e, c, key = _events(spark, sf_dir), F.col("cycle_id"), ["cycle_id", "user_id"]
    state = F.when(c % 10 == 9, "PENDING_SCORE").when(c % 10 == 8, "UNSCORABLE").otherwise("SCORED").alias("score_state")
    d = e.groupBy(*key).agg(F.min("ts").alias("start_at"), F.max("ts").alias("updated_at"), F.round(F.sum("value") / F.lit(10.0).cast("double"), 4).alias("raw"))
    nxt = F.lead("start_at").over(Window.partitionBy("user_id").orderBy("start_at"))
    end = F.when(c % 17 == 0, None).otherwise(F.least(F.col("start_at") + F.expr("interval 8 hours"), nxt))
    cycles = d.select(*key, "start_at", "updated_at", end.alias("end_at"), state, _scored(c, F.least(F.lit(21.0).cast("double"), F.col("raw"))).alias("strain"))
    r = e.where("event_type = 'click'").groupBy(*key).agg(F.max("ts").alias("updated_at"), F.max("k").alias("hi"), F.min("k").alias("lo"), F.max("value").alias("v"))
    recovery = r.select(
        *key, "updated_at", state, _scored(c, F.col("hi")).alias("recovery_score"), _scored(c, F.lit(40) + F.col("lo")).alias("resting_heart_rate"), _scored(c, F.round(F.lit(20.0).cast("double") + F.col("v") / F.lit(5.0).cast("double"), 4)).alias("hrv_rmssd_milli")
    )
    ratio = lambda base, by: F.round(F.lit(base).cast("double") + F.col("k") / F.lit(by).cast("double"), 4)
    sleep = e.where("event_type = 'view'").select(
        F.col("event_id").cast("string").alias("sleep_id"), *key, F.col("ts").alias("updated_at"), (F.col("k") % 4 == 0).alias("is_nap"), state, ratio(4.0, 20.0).alias("total_in_bed_hours"),
        F.round(F.col("value") / F.lit(100.0).cast("double"), 4).alias("sleep_debt_need_hours"), ratio(13.0, 25.0).alias("respiratory_rate"),
    )
    sport = F.element_at(F.array(*[F.lit(s) for s in ("run", "ride", "lift", "swim", "row")]), F.col("k") % 5 + 1)
    strain = F.when(F.col("k") % 7 != 0, F.round(F.least(F.lit(21.0).cast("double"), F.col("value") / F.lit(10.0).cast("double")), 4))
    workouts = e.where("event_type = 'purchase'").select(
        F.col("event_id").cast("string").alias("workout_id"), "user_id", F.col("ts").alias("start_at"), (F.col("ts") + F.expr("interval 37 minutes")).alias("end_at"), strain.alias("strain"),
        F.round(F.col("value") * F.lit(11.0).cast("double"), 4).alias("kilojoule"), sport.alias("sport_name"), (F.lit(90) + F.col("k")).alias("average_heart_rate"),
    )
    return {n: conform(df, n) for n, df in (("cycles", cycles), ("recovery", recovery), ("sleep", sleep), ("workouts", workouts))}


#: Features of the nation history.
HISTORY_FEATURES = ("recovery_score", "total", "prior")


def nation_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each nation (as user_id) and order date."""
    o, c = spark.read.parquet(f"{sf_dir}/orders.parquet"), spark.read.parquet(f"{sf_dir}/customer.parquet")
    h = o.join(c, o["o_custkey"] == c["c_custkey"]).groupBy(F.col("c_nationkey").cast("long").alias("user_id"), F.to_date("o_orderdate").alias("day")).agg(F.round(F.sum("o_totalprice"), 2).cast("double").alias("total"), F.count("*").alias("n"))
    w = Window.partitionBy("user_id").orderBy("day")
    h = h.withColumns({"cycle_id": F.col("user_id") * 100000 + F.datediff("day", F.lit("1990-01-01").cast("date")), "start_at": F.col("day").cast("timestamp"), "recovery_score": (F.col("n") * 37 % 101).cast("double")})
    return h.withColumn("prior", F.lag("recovery_score").over(w)).drop("n")


def nation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supervised_pairs(nation_history(spark, sf_dir))


def nation_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation history's walk-forward folds, each row once."""
    return fold_rows(nation_pairs(spark, sf_dir))
