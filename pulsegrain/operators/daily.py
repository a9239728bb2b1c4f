"""The daily summary: one row for each cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import elapsed_ms
from .tables import latest_by_key

CYCLE = ["user_id", "cycle_id"]


def main_sleep(sleep: DataFrame) -> DataFrame:
    """The latest main sleep of each cycle, the smaller id where times tie; naps
    and unknown naps are left out."""
    return latest_by_key(sleep.where(~F.col("is_nap")), CYCLE, ["updated_at", F.asc("sleep_id")])


def assign_workouts(workouts: DataFrame, cycles: DataFrame, bucket_hours: int = 24) -> DataFrame:
    """Each workout with the cycle of its user that contains its start, in
    [start_at, end_at); a null end is open; the latest start wins, then the
    larger id. Workouts that no cycle contains are dropped. Adds cycle_id.

    Open cycles need no range join: the one that wins is the last to start, a
    running maximum along the user's time. It is taken within a bucket of time
    and over the buckets before, so that a busy user is many windows. Closed ones
    are joined by user and bucket. A cycle that is long for its bucket takes
    wider ones, so that it has three copies at most, whatever its end; a workout
    has one for each width that its user's cycles have.
    """
    size = bucket_hours * 3600
    bucket = lambda ts: F.floor(F.unix_seconds(ts.cast("timestamp")) / size).cast("long")
    w = workouts.where(F.col("start_at").isNotNull() & F.col("user_id").isNotNull())
    c = cycles.where(F.col("start_at").isNotNull()).select("user_id", F.col("cycle_id"), F.col("start_at").alias("c_start"), F.col("end_at").alias("c_end"))

    line = w.select("user_id", F.col("start_at").alias("t"), F.lit(1).alias("kind"), "workout_id", F.lit(None).cast(c.schema["cycle_id"].dataType).alias("cycle_id"))
    opened = c.where(F.col("c_end").isNull()).select("user_id", F.col("c_start").alias("t"), F.lit(0).alias("kind"), F.lit(None).cast(w.schema["workout_id"].dataType).alias("workout_id"), "cycle_id")
    line = line.unionByName(opened).withColumn("bucket", bucket(F.col("t")))
    start = F.when(F.col("kind") == 0, F.struct(F.col("t").alias("c_start"), "cycle_id"))
    so_far = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    before = line.groupBy("user_id", "bucket").agg(F.max(start).alias("own"))
    before = before.withColumn("before", F.max("own").over(Window.partitionBy("user_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).drop("own")
    within = line.withColumn("within", F.max(start).over(so_far("user_id", "bucket").orderBy("t", "kind"))).where("kind = 1")
    # a cycle of the bucket starts after all before it
    by_open = within.join(before, ["user_id", "bucket"]).withColumn("best", F.coalesce("within", "before")).where("best is not null").select("user_id", "workout_id", "best")

    closed = c.where(F.col("c_end") > F.col("c_start")).withColumns({"b0": bucket(F.col("c_start")), "b1": bucket(F.col("c_end"))})
    closed = closed.withColumn("level", F.when(F.col("b1") - F.col("b0") <= 2, 0).otherwise(F.ceil(F.log2((F.col("b1") - F.col("b0")).cast("double")))).cast("int"))
    closed = closed.withColumn("bucket", F.explode(F.sequence(F.expr("shiftright(b0, level)"), F.expr("shiftright(b1, level)")))).drop("b0", "b1")
    levels = closed.select("user_id", "level").distinct()
    asked = w.select("user_id", "workout_id", "start_at", bucket(F.col("start_at")).alias("b")).join(levels, "user_id").select("user_id", "workout_id", "start_at", "level", F.expr("shiftright(b, level)").alias("bucket"))
    hit = asked.join(closed, ["user_id", "level", "bucket"]).where((F.col("start_at") >= F.col("c_start")) & (F.col("start_at") < F.col("c_end")))
    by_closed = hit.select("user_id", "workout_id", F.struct("c_start", "cycle_id").alias("best"))
    best = by_open.unionByName(by_closed).groupBy("user_id", "workout_id").agg(F.max("best").alias("best"))
    return w.join(best, ["user_id", "workout_id"]).select(*workouts.columns, F.col("best.cycle_id").alias("cycle_id"))


def workouts_by_cycle(cycles: DataFrame, assigned: DataFrame) -> DataFrame:
    """Counts and sums of each cycle's workouts; cycles without any have zeros."""
    w = assigned.groupBy(*CYCLE).agg(
        F.count("workout_id").alias("workout_count"),
        F.sum("strain").alias("workout_total_strain"),
        F.max("strain").alias("workout_max_strain"),
        F.sum("kilojoule").alias("workout_total_kilojoule"),
        (F.sum(elapsed_ms(F.col("start_at"), F.col("end_at"))) / F.lit(3600000.0)).alias("workout_total_duration_hours"),
    )
    out = cycles.select(*CYCLE).distinct().join(w, CYCLE, "left")
    zero = {"workout_count": F.lit(0).cast("long")}
    return out.select(*CYCLE, *[F.coalesce(c, zero.get(c, F.lit(0.0))).alias(c) for c in w.columns if c not in CYCLE])


_RECOVERY = ["user_calibrating", "recovery_score", "resting_heart_rate", "hrv_rmssd_milli", "spo2_percentage", "skin_temp_celsius"]
_SLEEP = [
    "total_in_bed_hours", "total_awake_hours", "total_no_data_hours", "total_light_sleep_hours", "total_slow_wave_sleep_hours", "total_rem_sleep_hours", "sleep_cycle_count", "disturbance_count",
    "baseline_sleep_need_hours", "sleep_debt_need_hours", "recent_strain_need_hours", "recent_nap_need_hours", "respiratory_rate", "sleep_performance_percentage", "sleep_consistency_percentage", "sleep_efficiency_percentage",
]


def daily_summary(cycles: DataFrame, recovery: DataFrame, sleep: DataFrame, workouts: DataFrame) -> DataFrame:
    """One row for each cycle, 40 columns: the cycle, its recovery, its latest
    main sleep and its workouts. Keys are unique in silver; joins are by user
    and cycle, so that they share one partitioning."""
    c = cycles.select(
        *CYCLE, "start_at", "end_at", "timezone_offset", F.col("score_state").alias("cycle_score_state"), *[F.col(n).alias(f"cycle_{n}") for n in ("strain", "kilojoule", "average_heart_rate", "max_heart_rate")]
    )
    r = recovery.select(*CYCLE, F.col("score_state").alias("recovery_score_state"), *_RECOVERY)
    s = main_sleep(sleep).select(*CYCLE, "sleep_id", F.col("score_state").alias("sleep_score_state"), *_SLEEP)
    w = workouts_by_cycle(cycles, assign_workouts(workouts, cycles))
    out = c.join(r, CYCLE, "left").join(s, CYCLE, "left").join(w, CYCLE, "left")
    return out.select("cycle_id", "user_id", *[n for n in out.columns if n not in CYCLE])


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A left join that fails if a key is repeated on either side."""
    for side, df in (("left", left), ("right", right)):
        if df.groupBy(*keys).count().where("count > 1").limit(1).count():
            raise ValueError(f"keys are not unique on the {side} side")
    return left.join(right, keys, "left")


def model_history(mart: DataFrame, cycles: DataFrame, recovery: DataFrame, sleep: DataFrame) -> DataFrame:
    """The mart with the inputs that only anomaly models use, by time."""
    out = mart.join(cycles.select(*CYCLE, "end_at"), CYCLE).join(recovery.select(*CYCLE, "resting_heart_rate", "skin_temp_celsius", "spo2_percentage"), CYCLE, "left")
    out = out.join(main_sleep(sleep).select(*CYCLE, "respiratory_rate"), CYCLE, "left")
    return out.orderBy("user_id", "start_at", "cycle_id")
