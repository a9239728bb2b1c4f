"""Landed records: reading, writing and the incremental window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RECORD_TYPES, RECORDS

CORRUPT = "_corrupt_record"


def _known(record_type: str) -> None:
    if record_type not in RECORD_TYPES:
        raise ValueError(f"unknown record type: {record_type}")


def read_bronze(spark: SparkSession, root: str, record_type: str, since: dt.date | None = None) -> DataFrame:
    """Records of a type, one JSON object a line, with pull_date; `since` prunes
    partitions. A line that is not an object is kept in _corrupt_record."""
    _known(record_type)
    schema = T.StructType([*RECORDS[record_type].fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.schema("value string, pull_date date").text(f"{root}/{record_type}")
    if since is not None:
        lines = lines.where(F.col("pull_date") >= F.lit(since))
    return lines.select(F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("r"), "pull_date").select("r.*", "pull_date")


def read_array_file(spark: SparkSession, path: str, record_type: str) -> DataFrame:
    """Files that each hold one JSON array of records; a file is read whole by
    one task. A file that is no such array is one row in _corrupt_record."""
    _known(record_type)
    schema = T.StructType([*RECORDS[record_type].fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def _documents(spark: SparkSession, path: str, schema: T.StructType, lines: bool) -> DataFrame:
    """JSON objects with the text of those that do not fit in _corrupt_record:
    one a line, so that large files are split, or one a file."""
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"columnNameOfCorruptRecord": CORRUPT}
    if not lines:
        return spark.read.schema(schema).options(multiLine=True, **options).json(path)
    # a blank line is no page; any other text is one, or a reject
    text = spark.read.schema("value string").text(path).where(F.trim("value") != "")
    return text.select(F.from_json("value", schema, options).alias("d")).select("d.*")


def read_pages(spark: SparkSession, path: str, record_type: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Landed pages {"records": [...], "next_token": ...}, one a file or one a
    line: (records, rejects). Items that are no objects are rejects, as text,
    and so is a page that cannot be read; nothing is lost between the two."""
    _known(record_type)
    page = T.StructType([T.StructField("records", T.ArrayType(T.StringType())), T.StructField("next_token", T.StringType())])
    item = lambda raw, page_broken: F.struct(raw.alias("raw"), F.lit(page_broken).alias("broken"))
    items = F.when(F.col(CORRUPT).isNotNull(), F.array(item(F.col(CORRUPT), True))).otherwise(F.transform("records", lambda r: item(r, False)))
    parsed = _documents(spark, path, page, lines).select(F.explode(items).alias("i")).select("i.*").withColumn("r", F.from_json("raw", RECORDS[record_type]))
    is_object = ~F.col("broken") & F.coalesce(F.trim("raw").startswith("{"), F.lit(False)) & F.col("r").isNotNull()
    return parsed.where(is_object).select("r.*"), parsed.where(~is_object).select("raw")


def read_export(spark: SparkSession, path: str, lines: bool = False) -> dict[str, DataFrame]:
    """Whole-export objects, one a file or one a line, as four record tables.
    A type that an export does not have gives no rows."""
    schema = T.StructType([T.StructField(n, T.ArrayType(RECORDS[n])) for n in RECORD_TYPES])
    export = _documents(spark, path, schema, lines)
    return {n: export.select(F.explode(n).alias("r")).select("r.*") for n in RECORD_TYPES}


def canonical_json(df: DataFrame) -> DataFrame:
    """One column `value`: each row as compact JSON with sorted keys."""
    def ordered(t: T.DataType, c):
        if isinstance(t, T.StructType):
            parts = [ordered(f.dataType, c[f.name]).alias(f.name) for f in sorted(t.fields, key=lambda f: f.name)]
            return F.when(c.isNotNull(), F.struct(*parts))
        return c

    return df.select(F.to_json(F.struct(*[ordered(df.schema[n].dataType, F.col(f"`{n}`")).alias(n) for n in sorted(df.columns)])).alias("value"))


def write_bronze(records: DataFrame, root: str, record_type: str, pull_date: dt.date) -> str:
    """Replace exactly one (type, pull date) partition; an empty pull empties it."""
    _known(record_type)
    path = f"{root}/{record_type}/pull_date={pull_date.isoformat()}"
    canonical_json(records.drop(CORRUPT, "pull_date")).write.mode("overwrite").text(path)
    return path


def write_bronze_pull(records: dict[str, DataFrame], root: str, pull_date: dt.date) -> dict[str, int]:
    """All four types of a pull; returns rows written by type."""
    if missing := [t for t in RECORD_TYPES if t not in records]:
        raise ValueError(f"missing record types: {', '.join(missing)}")
    for t in records:
        _known(t)
    counts = {}
    for t in RECORD_TYPES:
        write_bronze(records[t], root, t, pull_date)
        counts[t] = records[t].sparkSession.read.text(f"{root}/{t}/pull_date={pull_date.isoformat()}").count()
    return counts


def sync_start(today: dt.date, last_synced: dt.date | None, initial_days: int = 180) -> dt.date:
    """First date to read: the last synced one again, so that pending scores can
    mature; without one, the initial window."""
    if initial_days < 0:
        raise ValueError("initial_days must not be negative")
    return last_synced or today - dt.timedelta(days=initial_days)


def sync_landing(spark: SparkSession, landing: dict[str, str], root: str, now: dt.datetime, last_synced: dt.date | None, advance, initial_days: int = 180, lines: bool = False) -> dict[str, int]:
    """landing pages -> bronze for every type, then `advance(date)` last, so that
    a pull that fails is made again. Records that tell no time are taken; rejected
    items are kept as text in rejects/<type>, in the pull's partition."""
    if now.tzinfo is None:
        raise ValueError("now must have a time zone")
    today = now.astimezone(dt.timezone.utc).date()
    since = sync_start(today, last_synced, initial_days)
    pages = {t: read_pages(spark, landing[t], t, lines) for t in RECORD_TYPES}
    fresh = F.coalesce(F.to_date(F.try_to_timestamp("updated_at")) >= F.lit(since), F.lit(True))
    counts = write_bronze_pull({t: records.where(fresh) for t, (records, _) in pages.items()}, root, today)
    for t, (_, rejects) in pages.items():
        rejects.select(F.coalesce("raw", F.lit("null")).alias("value")).write.mode("overwrite").text(f"{root}/rejects/{t}/pull_date={today.isoformat()}")
    advance(today)
    return counts


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


#: How exported text is written and read: microseconds stay, and quotes are
#: doubled as other CSV readers expect.
CSV = {"header": True, "escape": '"', "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def export_csv(df: DataFrame, path: str) -> None:
    """A null is an empty field, an empty text is a quoted one."""
    df.write.mode("overwrite").options(**CSV).csv(path)


#: Stands for a quoted empty text while a file is read.
_EMPTY_TEXT = "\0empty"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What export_csv wrote, with the types of a schema. Texts may hold line
    ends, so a file is read whole by one task."""
    rows = spark.read.schema(schema).options(multiLine=True, emptyValue=_EMPTY_TEXT, **CSV).csv(path)
    text = lambda c: F.when(F.col(f"`{c}`") == _EMPTY_TEXT, "").otherwise(F.col(f"`{c}`")).alias(c)
    return rows.select(*[text(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in schema])
