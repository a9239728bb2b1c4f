"""Column functions; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours(milliseconds: Column) -> Column:
    """Milliseconds to decimal hours, in this order of operations."""
    return milliseconds / F.lit(1000.0) / F.lit(3600.0)


def minutes(milliseconds: Column) -> Column:
    return milliseconds / F.lit(60000.0)


def elapsed_ms(start: Column, end: Column) -> Column:
    """Millisecond boundaries crossed between two timestamps."""
    return F.unix_millis(end.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))


def day_number(ts: Column) -> Column:
    """0 for Sunday to 6 for Saturday, in the session's zone (UTC)."""
    return F.dayofweek(ts) - 1


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def banded(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the first edge above the value; the last label otherwise, also
    for a null (filter it out first where that is not wanted)."""
    out = None
    for edge, label in zip(edges, labels):
        out = F.when(value < edge, label) if out is None else out.when(value < edge, label)
    return out.otherwise(labels[-1])


# Edges and labels of the two bandings.
STRAIN_EDGES, STRAIN_LABELS = [8.0, 12.0, 16.0], ["Low (<8)", "Medium (8-12)", "High (12-16)", "Very High (16+)"]
SLEEP_EDGES, SLEEP_LABELS = [6.0, 7.0, 8.0, 9.0], ["< 6 hrs", "6-7 hrs", "7-8 hrs", "8-9 hrs", "9+ hrs"]


def strain_band(value: Column) -> Column:
    return banded(value, STRAIN_EDGES, STRAIN_LABELS)


def sleep_band(value: Column) -> Column:
    return banded(value, SLEEP_EDGES, SLEEP_LABELS)


def clipped(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Within [low, high]; null stays null (least and greatest skip nulls)."""
    return F.when(value.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), value)))


def finite(value: Column) -> Column:
    """NaN as null, so that comparisons and means skip it."""
    return F.nanvl(value, F.lit(None).cast("double"))


def coerced(text: Column, kind: str) -> Column:
    """A string leaf as a typed value, null if it cannot be one. Integers go
    through double; one with a fraction is null here, and the contract then
    reports the column."""
    if kind == "ts":
        return F.coalesce(F.try_to_timestamp(text))
    if kind in ("double", "hours"):
        number = finite(text.try_cast("double"))
        return hours(number) if kind == "hours" else number
    if kind in ("long", "int"):
        number = finite(text.try_cast("double"))
        exact = F.coalesce(text.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))
        return exact if kind == "long" else exact.try_cast("int")
    if kind == "bool":
        return text.try_cast("boolean")
    return text


def one_hot_weekday(ts: Column) -> list[Column]:
    """Seven 0/1 columns is_day_0 (Sunday) to is_day_6."""
    return [(day_number(ts) == i).cast("int").alias(f"is_day_{i}") for i in range(7)]
