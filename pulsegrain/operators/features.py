"""The feature mart: one row for each cycle, windows over each user's cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..functions import day_number

LOW_STRAIN = 8.0
FEATURES = (
    "day_of_week", "cycle_strain", "recovery_score", "hrv_rmssd_milli", "sleep_debt_need_hours", "recovery_score_7d_avg", "cycle_strain_7d_avg", "hrv_rmssd_milli_7d_avg", "prior_day_strain", "sleep_debt_7d_avg_hours",
    "sleep_debt_trend_hours", "days_since_last_low_strain_day",
)


def user_line(order: tuple[str, ...] = ("start_at", "cycle_id")) -> WindowSpec:
    return Window.partitionBy("user_id").orderBy(*order)


def rolling(value: Column, rows: int, kind: str = "avg") -> Column:
    """Mean, stddev or other aggregate of the last `rows` cycles, this included."""
    return getattr(F, kind)(value).over(user_line().rowsBetween(1 - rows, 0))


def day_index() -> Column:
    return F.row_number().over(user_line()).cast("long")


def rows_since(condition: Column) -> Column:
    """Rows since the last one where the condition held: 0 there, null before."""
    marked = F.max(F.when(condition, day_index())).over(user_line().rowsBetween(Window.unboundedPreceding, 0))
    return day_index() - marked


def mart_daily_features(daily: DataFrame) -> DataFrame:
    """Fifteen columns for each cycle; rolling values count cycles, not days."""
    d = daily.select("cycle_id", "user_id", "start_at", "cycle_strain", "recovery_score", "hrv_rmssd_milli", "sleep_debt_need_hours").withColumn("__i", day_index())
    low = F.max(F.when(F.col("cycle_strain") < LOW_STRAIN, F.col("__i"))).over(user_line().rowsBetween(Window.unboundedPreceding, 0))
    debt = rolling(F.col("sleep_debt_need_hours"), 7)
    return d.select(
        "cycle_id", "user_id", "start_at", day_number(F.col("start_at")).alias("day_of_week"), "cycle_strain", "recovery_score", "hrv_rmssd_milli", "sleep_debt_need_hours",
        *[rolling(F.col(c), 7).alias(f"{c}_7d_avg") for c in ("recovery_score", "cycle_strain", "hrv_rmssd_milli")],
        F.lag("cycle_strain").over(user_line()).alias("prior_day_strain"),
        debt.alias("sleep_debt_7d_avg_hours"), (F.col("sleep_debt_need_hours") - debt).alias("sleep_debt_trend_hours"),
        (F.col("__i") - low).alias("days_since_last_low_strain_day"),
    )


def strain_stability(daily: DataFrame, rows: int = 7) -> DataFrame:
    """Rolling standard deviation of strain: steady against spiky."""
    return daily.select("user_id", "cycle_id", "start_at", "cycle_strain", rolling(F.col("cycle_strain"), rows, "stddev_samp").alias("strain_spread"))


def rolling_statistics(daily: DataFrame, column: str, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Mean and spread of a column over the last cycles, for each window."""
    v = F.col(column)
    return daily.select("user_id", "cycle_id", "start_at", *[rolling(v, n, k).alias(f"{column}_{n}_{k}") for n in windows for k in ("avg", "stddev_samp")])


def recent_rows(df: DataFrame, n: int, order: tuple[str, ...] = ("start_at", "cycle_id")) -> DataFrame:
    """The last n rows of each user (a sliding training window, a tail)."""
    w = Window.partitionBy("user_id").orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")
