"""Streams of landed records into gold tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.daily import CYCLE, daily_summary
from ..operators.features import mart_daily_features
from ..operators.flatten import flatten
from ..operators.tables import Store, latest_by_key
from ..schemas import KEYS, RECORD_TYPES, RECORDS, SILVER


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """All record types as one stream of (type, raw): <root>/<type>/... lines."""
    lines = spark.readStream.schema(T.StructType([T.StructField("value", T.StringType())])).option("recursiveFileLookup", True).format("text").load(root)
    kind = F.regexp_extract(F.col("_metadata.file_path"), f"/({'|'.join(RECORD_TYPES)})/", 1)
    return lines.select(kind.alias("type"), F.col("value").alias("raw"))


#: Each table's key as landed records name it.
_RAW_KEYS = {t: next(path for name, path, _ in SILVER[t] if name == KEYS[t]) for t in RECORD_TYPES}


def _parsed(batch: DataFrame, record_type: str) -> DataFrame:
    return batch.where(F.col("type") == record_type).select("type", "raw", F.from_json("raw", RECORDS[record_type]).alias("r"))


def rejected(batch: DataFrame) -> DataFrame:
    """(type, raw) of lines that are no record, or have no key, or no known type."""
    parts = [_parsed(batch, t).where(F.col("r").isNull() | F.col(f"r.{_RAW_KEYS[t]}").isNull()).select("type", "raw") for t in RECORD_TYPES]
    return reduce(DataFrame.unionByName, parts, batch.where(~F.coalesce(F.col("type").isin(*RECORD_TYPES), F.lit(False))).select("type", "raw"))


def silver_batch(batch: DataFrame) -> dict[str, DataFrame]:
    """Typed tables of a batch, the newest version of each key; `rejected` has
    the lines that are left out."""
    out = {}
    for t in RECORD_TYPES:
        records = _parsed(batch, t).where(F.col(f"r.{_RAW_KEYS[t]}").isNotNull()).select("r.*")
        out[t] = latest_by_key(flatten(records, t), [KEYS[t]], ["updated_at"])
    return out


def gold_writer(store: Store, stream: str, today: dt.date | None = None):
    """A foreachBatch function: contract, then bad lines to the table `rejects`,
    the silver tables, and the mart of the users that the batch touches, all in
    one transaction with the batch's id. A batch that the manifest has seen is
    left out, and one that failed in between has left nothing behind."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if store.manifest()["batches"].get(stream, -1) >= batch_id:
            return
        from ..operators.contracts import enforce
        from ..operators.staging import staged

        batch = staged(batch, store, "landed")
        silver = {n: staged(df, store, n) for n, df in silver_batch(batch).items()}
        enforce(silver)
        bad = rejected(batch).withColumn("batch", F.lit(batch_id).cast("long"))
        users = reduce(DataFrame.unionByName, [silver[n].select("user_id") for n in silver]).distinct()

        def gold(tx) -> None:
            if not bad.isEmpty():
                tx.append("rejects", bad)
            for n in silver:
                tx.merge(n, silver[n], KEYS[n])
            own = {n: tx.read(n).join(users, "user_id", "left_semi") for n in RECORD_TYPES}
            mart = mart_daily_features(daily_summary(own["cycles"], own["recovery"], own["sleep"], own["workouts"]))
            tx.merge("mart_daily_features", mart, "user_id")

        store.update(gold, today, (stream, batch_id))

    return write


def run_available(spark: SparkSession, landing: str, store: Store, checkpoint: str, stream: str = "landing"):
    """Process what has landed so far and stop."""
    query = read_landed(spark, landing).writeStream.foreachBatch(gold_writer(store, stream)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def daily_rollup(cycles: DataFrame, delay: str = "2 days") -> DataFrame:
    """Cycles, mean strain and energy of each day of event time; late rows up
    to `delay` count. Works on streams (append mode) and tables."""
    d = cycles.withWatermark("start_at", delay) if cycles.isStreaming else cycles
    out = d.groupBy(F.window("start_at", "1 day")).agg(F.count("*").alias("cycles"), F.avg("strain").alias("avg_strain"), F.sum("kilojoule").alias("kilojoule"))
    return out.select(F.col("window.start").alias("day"), "cycles", "avg_strain", "kilojoule")
