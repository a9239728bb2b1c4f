"""Nested records to typed silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coerced
from ..schemas import SILVER


def flatten(records: DataFrame, table: str) -> DataFrame:
    """Typed columns of a record table. Score columns are null unless the state
    is SCORED, even where a score is present; missing objects give nulls and
    scalars that cannot be converted become null. Empty input stays typed."""
    scored = F.col("score_state") == "SCORED"

    def column(name: str, path: str, kind: str):
        leaf = F.col(path)
        if path.startswith("score."):
            leaf = F.when(scored, leaf)
        return coerced(leaf, kind).alias(name)

    return records.select(*[column(*spec) for spec in SILVER[table]])


def flatten_cycles(records: DataFrame) -> DataFrame:
    return flatten(records, "cycles")


def flatten_recovery(records: DataFrame) -> DataFrame:
    return flatten(records, "recovery")


def flatten_sleep(records: DataFrame) -> DataFrame:
    return flatten(records, "sleep")


def flatten_workouts(records: DataFrame) -> DataFrame:
    return flatten(records, "workouts")


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's silver columns in order and type; absent ones are null."""
    from ..schemas import silver_type

    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in silver_type(table).fields])
