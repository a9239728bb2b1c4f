"""Contracts: every violation of every table, before anything is written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import KEYS, RECORD_TYPES, SCORE_STATES, ranges, required, silver_type

REPORT = "table string, column string, rule string, violations bigint, sample array<string>"


class ContractError(ValueError):
    """Raised with the report's rows as text."""


def outside(column: Column, low: float | None, high: float | None) -> Column:
    """True where a present value is out of range; null passes, bounds may be open."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (column < low)
    if high is not None:
        bad = bad | (column > high)
    return F.coalesce(column.isNotNull() & bad, F.lit(False))


def range_violations(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return df.where(outside(F.col(column), low, high))


def orphan_keys(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Child rows whose keys no parent row has."""
    return child.join(parent.select(*keys).distinct(), keys, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def rules_report(df: DataFrame, table: str, key: str, rules: dict[tuple[str, str], Column]) -> DataFrame:
    """One row for each broken rule; rules: (column, name) -> is violated. All
    rules of a table take one pass, uniqueness of the key one grouping more."""
    name = F.col(key).cast("string")
    counts = df.agg(*[F.struct(F.count_if(bad).alias("n"), F.min(F.when(bad, name)).alias("low"), F.max(F.when(bad, name)).alias("high")).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(f"r{i}.n").alias("violations"), F.array_distinct(F.array_compact(F.array(f"r{i}.low", f"r{i}.high"))).alias("sample")) for i, (c, r) in enumerate(rules)])
    found = counts.select(F.explode(lines).alias("x")).select("x.*").where("violations > 0")
    twice = duplicate_keys(df.where(F.col(key).isNotNull()), [key]).agg(F.count("*").alias("violations"), F.min(F.col(key).cast("string")).alias("low"), F.max(F.col(key).cast("string")).alias("high")).where("violations > 0")
    twice = twice.select(F.lit(key).alias("column"), F.lit("unique").alias("rule"), "violations", F.array_distinct(F.array("low", "high")).alias("sample"))
    return found.unionByName(twice).select(F.lit(table).alias("table"), "column", "rule", F.col("violations").cast("long"), "sample")


def table_rules(table: str) -> dict[tuple[str, str], Column]:
    """Contract rules of a silver table."""
    out = {(c, "not_null"): F.col(c).isNull() for c in required(table)}
    for c, (low, high) in ranges(table).items():
        out[(c, "range")] = outside(F.col(c), low, high)
    out[("score_state", "allowed")] = F.coalesce(~F.col("score_state").isin(*SCORE_STATES), F.lit(False))
    return out


def contract_report(frames: dict[str, DataFrame]) -> DataFrame:
    """All violations of all four tables; missing tables and wrong columns or
    types are rows as well."""
    spark = next(iter(frames.values())).sparkSession
    parts, shape = [], []
    for table in RECORD_TYPES:
        if table not in frames:
            shape.append((table, "", "missing_table", 1, []))
            continue
        want, have = silver_type(table), frames[table].schema
        bad = [(table, f.name, "missing_column", 1, []) for f in want if f.name not in have.names]
        bad += [(table, f.name, "extra_column", 1, []) for f in have if f.name not in want.names]
        bad += [(table, f.name, "type", 1, [have[f.name].dataType.simpleString()]) for f in want if f.name in have.names and have[f.name].dataType != f.dataType]
        shape += bad
        if not any(b[2] != "extra_column" for b in bad):
            parts.append(rules_report(frames[table], table, KEYS[table], table_rules(table)))
    if shape or not parts:
        parts.append(spark.createDataFrame(shape, REPORT))
    return reduce(DataFrame.unionByName, parts)


def enforce(frames: dict[str, DataFrame]) -> None:
    """Raise ContractError unless the report is empty. Its rows are few: one a rule."""
    rows = contract_report(frames).orderBy("table", "column", "rule").collect()
    if rows:
        raise ContractError("; ".join(f"{r['table']}.{r['column']} {r['rule']} x{r['violations']} {r['sample']}" for r in rows))
