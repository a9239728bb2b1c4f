"""Exploratory tables over the daily summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import sleep_band, strain_band, weekday_name, year_month
from ..scratch import materialise
from .quantiles import exact_quantiles


def weekday_profile(daily: DataFrame) -> DataFrame:
    """Means by weekday, Monday first."""
    d = daily.where("recovery_score is not null")
    out = d.groupBy(weekday_name(F.col("start_at")).alias("weekday"), F.weekday("start_at").alias("weekday_order")).agg(
        F.avg("recovery_score").alias("avg_recovery"), F.avg("cycle_strain").alias("avg_strain"), F.avg("total_in_bed_hours").alias("avg_in_bed"), F.count("*").alias("n")
    )
    return out.orderBy("weekday_order")


def monthly_trend(daily: DataFrame, months: int = 12) -> DataFrame:
    """Means by month, newest first."""
    d = daily.where("recovery_score is not null").groupBy(year_month(F.col("start_at")).alias("month"))
    out = d.agg(
        F.avg("recovery_score").alias("avg_recovery"), F.avg("hrv_rmssd_milli").alias("avg_hrv"), F.avg("cycle_strain").alias("avg_strain"), F.avg("total_in_bed_hours").alias("avg_in_bed"), F.count("*").alias("n")
    )
    return out.orderBy(F.desc("month")).limit(months)


def recovery_cycles(daily: DataFrame) -> DataFrame:
    """Weekly and monthly cycles: mean recovery at each weekday (1 to 7, Monday
    first) and day of the month, and its distance from the overall mean."""
    d = daily.where("recovery_score is not null")
    places = F.array(F.struct(F.lit("week").alias("cycle"), (F.weekday("start_at") + 1).alias("position")), F.struct(F.lit("month").alias("cycle"), F.dayofmonth("start_at").alias("position")))
    out = d.select("recovery_score", F.explode(places).alias("at")).groupBy("at.cycle", "at.position").agg(F.avg("recovery_score").alias("avg_recovery"), F.count("*").alias("n"))
    whole = F.broadcast(d.agg(F.avg("recovery_score").alias("__mean")))  # a single row
    return out.join(whole, F.lit(True)).withColumn("from_mean", F.col("avg_recovery") - F.col("__mean")).drop("__mean")


def sport_profile(workouts: DataFrame, top: int = 10) -> DataFrame:
    """Counts, means and energy of each named sport, most frequent first."""
    from ..functions import elapsed_ms, minutes

    length = minutes(elapsed_ms(F.col("start_at"), F.col("end_at")))
    out = workouts.where("sport_name is not null").groupBy("sport_name").agg(
        F.count("*").alias("n"), F.avg("strain").alias("avg_strain"), F.avg(length).alias("avg_minutes"), F.avg("average_heart_rate").alias("avg_heart_rate"), F.sum("kilojoule").alias("total_kilojoule")
    )
    return out.orderBy(F.desc("n"), "sport_name").limit(top)


def strain_effect(daily: DataFrame) -> DataFrame:
    """Recovery by the band of the previous scored cycle's strain."""
    prior = F.lag("cycle_strain").over(Window.partitionBy("user_id").orderBy("start_at", "cycle_id"))
    d = daily.where("recovery_score is not null").withColumn("prior_strain", prior).where("prior_strain is not null")
    return d.groupBy(strain_band(F.col("prior_strain")).alias("strain_band")).agg(F.avg("recovery_score").alias("avg_recovery"), F.count("*").alias("n"))


def sleep_effect(daily: DataFrame) -> DataFrame:
    """Recovery and HRV by hours in bed."""
    d = daily.where("total_in_bed_hours is not null and recovery_score is not null")
    return d.groupBy(sleep_band(F.col("total_in_bed_hours")).alias("sleep_band")).agg(F.avg("recovery_score").alias("avg_recovery"), F.avg("hrv_rmssd_milli").alias("avg_hrv"), F.count("*").alias("n"))


def best_sleep_band(daily: DataFrame) -> DataFrame:
    """The band of hours in bed with the highest mean recovery."""
    return sleep_effect(daily).orderBy(F.desc("avg_recovery"), "sleep_band").limit(1)


def extremes(daily: DataFrame, column: str = "recovery_score", n: int = 5) -> DataFrame:
    """The n rows with the largest and the n with the smallest value."""
    d = daily.where(F.col(column).isNotNull()).select("cycle_id", "user_id", "start_at", column)
    top = d.orderBy(F.desc(column), "cycle_id").limit(n).withColumn("side", F.lit("top"))
    return top.unionByName(d.orderBy(F.asc(column), "cycle_id").limit(n).withColumn("side", F.lit("bottom")))


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(n)


def above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.where(F.col(column) > threshold)


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows of each value (as text), most frequent first."""
    out = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")
    return out.limit(top) if top else out


def table_profile(df: DataFrame, time_column: str | None = None) -> DataFrame:
    """One row for each column: rows, nulls, percent of nulls, and the time range."""
    span = [F.min(time_column).alias("__lo"), F.max(time_column).alias("__hi")] if time_column else [F.lit(None).cast("timestamp").alias("__lo"), F.lit(None).cast("timestamp").alias("__hi")]
    one = df.agg(F.count("*").alias("__n"), *span, *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = one.select("__n", "__lo", "__hi", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])).alias("x"))
    share = F.when(F.col("__n") > 0, F.col("x.nulls") * 100.0 / F.col("__n"))
    return long.select("x.column_name", F.col("__n").alias("n_rows"), "x.nulls", share.alias("null_percent"), F.col("__lo").alias("first_at"), F.col("__hi").alias("last_at"))


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum. The columns
    are written once and scanned three times, whatever plan they come from."""
    df = materialise(df.select(*columns), "numbers")
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])

    def of(c: str) -> Column:
        v = F.col(c).cast("double")
        q = [F.lit(x).cast("double").alias(n) for x, n in zip(quartiles[c], ("q25", "q50", "q75"))]
        return F.struct(F.lit(c).alias("column_name"), F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), *q, F.max(v).alias("max"))

    return df.agg(F.array(*[of(c) for c in columns]).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def key_audit(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows against distinct keys of each table."""
    parts = [df.agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows"), F.countDistinct(k).alias("n_keys")) for n, (df, k) in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def key_overlap(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Distinct keys of each table, and of each pair's intersection."""
    sets = {n: df.where(F.col(key).isNotNull()).select(key).distinct() for n, df in frames.items()}
    count = lambda df, a, b: df.agg(F.lit(a).alias("left_table"), F.lit(b).alias("right_table"), F.count("*").alias("n"))
    parts = [count(df, n, n) for n, df in sets.items()]
    names = list(sets)
    parts += [count(sets[a].intersect(sets[b]), a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    return reduce(DataFrame.unionByName, parts)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal bins from the minimum to the maximum, the last closed,
    with the overall mean beside each; empty bins are left out."""
    v = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    one = F.broadcast(v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("mean")))  # a single row
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))))).otherwise(0).cast("int")
    out = v.join(one, F.lit(True)).groupBy(at.alias("bin"), "lo", "hi", "mean").agg(F.count("*").alias("n"))
    return out.select("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"), "n", "mean")


def lag_correlation(df: DataFrame, column: str, lag: int = 1) -> DataFrame:
    """Autocorrelation of each user's series at a lag (null where either side
    does not vary); pairs: rows with a value before, both: those with a value of
    their own as well."""
    before = F.lag(column, lag).over(Window.partitionBy("user_id").orderBy("start_at", "cycle_id"))
    x, y = F.col(column).cast("double"), F.col("__before").cast("double")
    both = x.isNotNull() & y.isNotNull()
    # corr divides by the deviations, which under ANSI is an error for a constant side
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    out = df.withColumn("__before", before).groupBy("user_id")
    return out.agg(F.try_divide(F.covar_pop(x, y), spread).alias("correlation"), F.count("__before").alias("pairs"), F.count(F.when(both, 1)).alias("both"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def replace_table(df: DataFrame, name: str) -> None:
    """Drop and create a catalog table from a query."""
    df.write.mode("overwrite").saveAsTable(name)


def list_tables(spark) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def describe(df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema], "column_name string, type string, nullable boolean")
