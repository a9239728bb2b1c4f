"""Error windows, retraining decisions and forecast quality over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def error_windows(errors: DataFrame, order: list[str]) -> DataFrame:
    """Each user's newest error, the bias and MAE of the last seven, the MAE of
    the seven before, and how many there are (14 at most). errors: user_id,
    error (predicted - actual) and the order columns."""
    w = Window.partitionBy("user_id").orderBy(*[F.desc(c) for c in order])
    e = errors.where("error is not null").withColumn("__r", F.row_number().over(w)).where("__r <= 14")
    new, old = F.col("__r") <= 7, F.col("__r") > 7
    return e.groupBy("user_id").agg(
        F.count("*").alias("n_errors"), F.max(F.when(F.col("__r") == 1, F.col("error"))).alias("last_error"), F.avg(F.when(new, F.col("error"))).alias("bias_7"),
        F.avg(F.when(new, F.abs("error"))).alias("mae_7"), F.avg(F.when(old, F.abs("error"))).alias("mae_previous_7"),
        F.count_if(F.isnan("error") | (F.abs("error") == float("inf"))).alias("bad_errors"),
    )


def retrain_decision(windows: DataFrame) -> DataFrame:
    """windows (with days_since_update) plus should_update and reason. In order:
    a last error over 15 points, a bias over 5, a MAE that rose by more than 1,
    seven days since the update; else stable. Bounds are strict. Errors that are
    not finite, or negative days, are reported as invalid."""
    enough = lambda n: F.coalesce(F.col("n_errors") >= n, F.lit(False))
    reason = (
        F.when(F.coalesce(F.col("bad_errors") > 0, F.lit(False)) | (F.col("days_since_update") < 0), "invalid")
        .when(F.abs("last_error") > 15, "emergency").when(enough(7) & (F.abs("bias_7") > 5), "bias_correction")
        .when(enough(14) & (F.col("mae_7") > F.col("mae_previous_7") + 1), "drift_correction").when(F.col("days_since_update") >= 7, "routine").otherwise("stable")
    )
    return windows.withColumn("reason", reason).withColumn("should_update", ~F.col("reason").isin("stable", "invalid"))


def error_outliers(predictions: DataFrame, sigmas: float = 2.0) -> DataFrame:
    """Settled predictions whose error is over `sigmas` deviations from the
    user's mean error."""
    s = predictions.where("error is not null").groupBy("user_id").agg(F.avg("error").alias("__m"), F.stddev_samp("error").alias("__s"))
    return predictions.join(s, "user_id").where(F.abs(F.col("error") - F.col("__m")) > sigmas * F.col("__s")).drop("__m", "__s")


def rolling_errors(predictions: DataFrame, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """MAE, RMSE, bias, error variance and R2 over each model's last forecasts."""
    out = predictions.where("error is not null")
    for n in windows:
        w = Window.partitionBy("user_id", "model_name").orderBy("origin_at", "cycle_id").rowsBetween(1 - n, 0)
        e = F.col("error")
        total = F.var_pop("actual_value").over(w)
        out = out.withColumns({
            f"mae_{n}": F.avg(F.abs(e)).over(w), f"rmse_{n}": F.sqrt(F.avg(e * e).over(w)), f"bias_{n}": F.avg(e).over(w), f"variance_{n}": F.var_pop(e).over(w),
            f"r2_{n}": F.when(total > 0, 1 - F.avg(e * e).over(w) / F.when(total > 0, total)),
        })
    return out


def interval_coverage(predictions: DataFrame) -> DataFrame:
    """Share of settled actuals inside their interval, and its mean width."""
    inside = F.col("actual_value").between(F.col("ci_lower"), F.col("ci_upper"))
    return predictions.where("actual_value is not null").groupBy("user_id", "model_name").agg(F.avg(inside.cast("double")).alias("coverage"), F.avg(F.col("ci_upper") - F.col("ci_lower")).alias("mean_width"), F.count("*").alias("n"))


def persistence_forecast(pairs: DataFrame) -> DataFrame:
    """The baseline that predicts today's recovery for the next cycle."""
    return pairs.withColumn("predicted", F.col("recovery_score").cast("double"))
