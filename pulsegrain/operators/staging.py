"""Intermediate tables beside a store, so that a plan that is read several
times runs once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def staged(df: DataFrame, store, label: str) -> DataFrame:
    path = f"{store.root}/_staging/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return store.spark.read.schema(df.schema).parquet(path)
