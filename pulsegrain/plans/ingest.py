"""Queries of landing and publishing: what readers, syncs and exports leave as
rows, from files that Spark writes out of events in each run.

A landed page, export or array file holds a bounded number of events, so that
files grow in number with the input and not in size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..operators import anomaly, daily, features, supervised
from ..operators.flatten import flatten
from ..operators.tables import Store
from ..schemas import RECORD_TYPES, SILVER
from .inputs import nation_history, silver
from .landed import _fresh
from .more import _RAW, event_records, record_shape
from .oracle import DAILY, MART, SHAPES
from .registry import ROBUST, WATCHED, _daily, _plain, query, rounded

_SHAPE = {t: record_shape(t) for t in RECORD_TYPES}


def _record(table: str) -> Column:
    """An event as a landed record of a table, in JSON."""
    return F.to_json(F.expr(_SHAPE[table][0]), {"ignoreNullFields": "false"})


def _value(table: str, column: str) -> str:
    """The flattened column of an event's record, in DuckDB."""
    i = [n for n, _, _ in SILVER[table]].index(column)
    return _SHAPE[table][1][i].rsplit(" as ", 1)[0]


def _chunk(size: int) -> Column:
    return F.floor(F.col("event_id") / size)


def _page(items: Column) -> Column:
    return F.concat(F.lit('{"records":['), F.array_join(items, ","), F.lit('],"next_token":"next"}'))


# ---------------------------------------------------------------- readers
#: Of 18 items one is a number and one a text; a tenth of the pages is cut off.
_ITEM = "event_id % 18 not in (0, 9)"


@query(_RAW + f""", whole as (select * from raw where event_id // 100 % 10 <> 3)
select 'record' as kind, event_id::varchar as key, {_value('cycles', 'score_state')} as score_state, {_value('cycles', 'strain')} as strain from whole where {_ITEM}
union all select 'reject', case event_id % 18 when 0 then event_id::varchar else 'lost ' || event_id end, null, null from whole where not ({_ITEM})
union all select distinct 'reject', '{{"records":[ page ' || event_id // 100, null, null from raw where event_id // 100 % 10 = 3""")
def landed_pages(spark, sf_dir):
    """Every item of every landed page, either as a flattened record or as a
    rejected text; pages that are cut off are rejects too."""
    e, path = event_records(spark, sf_dir), _fresh(spark, "pages")
    item = F.when(F.col("event_id") % 18 == 0, F.col("event_id").cast("string")).when(F.col("event_id") % 18 == 9, F.concat(F.lit('"lost '), "event_id", F.lit('"'))).otherwise(_record("cycles"))
    pages = e.groupBy(_chunk(100).alias("page")).agg(F.collect_list(item).alias("items"))
    cut = F.concat(F.lit('{"records":[ page '), "page")
    pages.select(F.when(F.col("page") % 10 == 3, cut).otherwise(_page(F.col("items"))).alias("value")).write.text(path)
    records, rejects = sources.read_pages(spark, path, "cycles", lines=True)
    flat = flatten(records, "cycles").select(F.lit("record").alias("kind"), F.col("cycle_id").cast("string").alias("key"), "score_state", "strain")
    return flat.unionByName(rejects.select(F.lit("reject").alias("kind"), F.col("raw").alias("key")), allowMissingColumns=True)


#: What is compared of each table: its key and a measurement.
_EXPORTED = {"cycles": ("cycle_id", "strain"), "recovery": ("cycle_id", "hrv_rmssd_milli"), "sleep": ("sleep_id", "total_in_bed_hours"), "workouts": ("workout_id", "kilojoule")}


@query(_RAW + " union all ".join(
    f"select '{t}' as record_type, ({_value(t, key)})::varchar as key, user_id, round({_value(t, measured)}, 6) as measured from raw where event_id % 4 = {i}" + (" and event_id // 200 % 5 <> 4" if t == "workouts" else "")
    for i, (t, (key, measured)) in enumerate(_EXPORTED.items())
))
def export_tables(spark, sf_dir):
    """Whole-export objects taken apart into four tables; a fifth of them has no
    workouts."""
    e, path = event_records(spark, sf_dir), _fresh(spark, "exports")
    lists = [F.collect_list(F.when(F.col("event_id") % 4 == i, _record(t))).alias(t) for i, t in enumerate(RECORD_TYPES)]
    entry = lambda t: F.concat(F.lit(f'"{t}":['), F.array_join(t, ","), F.lit("]"))
    some = F.filter(F.array(*[entry(t) for t in RECORD_TYPES[:3]], F.when(F.col("chunk") % 5 != 4, entry("workouts"))), lambda x: x.isNotNull())
    e.groupBy(_chunk(200).alias("chunk")).agg(*lists).select(F.concat(F.lit("{"), F.array_join(some, ","), F.lit("}")).alias("value")).write.text(path)
    out = None
    for t, df in sources.read_export(spark, path, lines=True).items():
        key, measured = _EXPORTED[t]
        rows = flatten(df, t).select(F.lit(t).alias("record_type"), F.col(key).cast("string").alias("key"), "user_id", F.col(measured).alias("measured"))
        out = rows if out is None else out.unionByName(rows)
    return rounded(out)


@query(_RAW + f""" select 'record' as kind, {_value('sleep', 'sleep_id')} as key, {_value('sleep', 'is_nap')} as is_nap, {_value('sleep', 'respiratory_rate')} as respiratory_rate from raw where event_id // 500 % 7 <> 1
union all select distinct 'reject', '[ file ' || event_id // 500, null, null from raw where event_id // 500 % 7 = 1""")
def array_files(spark, sf_dir):
    """Files of one JSON array each, flattened; a file that is none is a row."""
    e, path = event_records(spark, sf_dir), _fresh(spark, "arrays")
    files = e.groupBy(_chunk(500).alias("file")).agg(F.collect_list(_record("sleep")).alias("items"))
    whole = F.concat(F.lit("["), F.array_join("items", ","), F.lit("]"))
    files.select("file", F.when(F.col("file") % 7 == 1, F.concat(F.lit("[ file "), "file")).otherwise(whole).alias("value")).write.partitionBy("file").text(path)
    back, broken = sources.read_array_file(spark, path, "sleep"), F.col(sources.CORRUPT).isNotNull()
    flat = flatten(back.where(~broken), "sleep").select(F.lit("record").alias("kind"), F.col("sleep_id").alias("key"), "is_nap", "respiratory_rate")
    lost = back.where(broken & F.col("id").isNull()).select(F.lit("reject").alias("kind"), F.trim(F.regexp_replace(sources.CORRUPT, "\\s+$", "")).alias("key"))
    return flat.unionByName(lost, allowMissingColumns=True)


# ---------------------------------------------------------------- sync
#: Two pulls; the second begins on the day that the first one reached.
_PULLS = ((dt.date(2024, 1, 15), dt.date(2024, 1, 5)), (dt.date(2024, 1, 22), dt.date(2024, 1, 15)))
_TYPE = "case event_id % 4 " + " ".join(f"when {i} then '{t}'" for i, t in enumerate(RECORD_TYPES)) + " end"


@query(_RAW + ", pulls(pull_date, since) as (values " + ", ".join(f"(date '{day}', date '{since}')" for day, since in _PULLS) + f""")
select {_TYPE} as record_type, pull_date, event_id % 18 = 0 as rejected, event_id::varchar as key from raw, pulls where ts < pull_date and (event_id % 18 = 0 or event_id % 50 = 0 or ts::date >= since)""")
def synced_bronze(spark, sf_dir):
    """Bronze after two syncs from landed pages: the first reads its initial
    window, the second from the day in the checkpoint on, that day again. A
    fiftieth of the records tells no time and is always taken."""
    root = _fresh(spark, "sync")
    store, bronze = Store(spark, f"{root}/state"), f"{root}/bronze"
    e = event_records(spark, sf_dir)
    record = F.coalesce(*[F.when(F.col("event_id") % 4 == i, _record(t)) for i, t in enumerate(RECORD_TYPES)])
    record = F.when(F.col("event_id") % 50 == 0, F.regexp_replace(record, '"updated_at":"[^"]*"', '"updated_at":null')).otherwise(record)
    item = F.when(F.col("event_id") % 18 == 0, F.col("event_id").cast("string")).otherwise(record)
    for day, _ in _PULLS:
        now = dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc)
        pages = e.where(F.col("ts") < F.lit(now)).groupBy(F.expr(_TYPE).alias("type"), _chunk(400).alias("page")).agg(F.collect_list(item).alias("items"))
        pages.select("type", _page(F.col("items")).alias("value")).write.partitionBy("type").text(f"{root}/landing/{day}")
        landing = {t: f"{root}/landing/{day}/type={t}" for t in RECORD_TYPES}
        sources.sync_landing(spark, landing, bronze, now, store.last_synced_date(), lambda d: store.commit({}, last_synced_date=d), initial_days=10, lines=True)
    out = None
    for t in RECORD_TYPES:
        key = "cycle_id" if t == "recovery" else "id"
        got = sources.read_bronze(spark, bronze, t).select("pull_date", F.lit(False).alias("rejected"), F.regexp_extract(key, "[0-9]+", 0).alias("key"))
        lost = spark.read.schema("value string, pull_date date").text(f"{bronze}/rejects/{t}").select("pull_date", F.lit(True).alias("rejected"), F.col("value").alias("key"))
        rows = got.unionByName(lost).withColumn("record_type", F.lit(t))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("select '{\"id\":\"' || event_id || '\",\"note\":\"' || event_type || ' \\\"' || user_id || '\\\"\"' || case when event_id % 3 = 0 then ',\"score\":{\"average_heart_rate\":\"' || json_extract_string(props, '$.k') || '\",\"strain\":\"' || value || '\"}' else '' end || ',\"user_id\":\"' || user_id || '\"}' as value from events")
def canonical_records(spark, sf_dir):
    """Records as compact JSON, keys in order at every level."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    score = F.when(F.col("event_id") % 3 == 0, F.struct(F.col("value").cast("string").alias("strain"), F.get_json_object("props", "$.k").alias("average_heart_rate")))
    note = F.concat("event_type", F.lit(' "'), "user_id", F.lit('"'))
    return sources.canonical_json(e.select(F.col("user_id").cast("string").alias("user_id"), score.alias("score"), note.alias("note"), F.col("event_id").cast("string").alias("id")))


# ---------------------------------------------------------------- joins and columns
@query(SHAPES + "select c.user_id, c.cycle_id, c.strain, r.recovery_score from cycles c left join recovery r on r.user_id = c.user_id and r.cycle_id = c.cycle_id")
def checked_join(spark, sf_dir):
    """Cycles with their recovery, after a check that neither repeats a key."""
    t, keys = silver(spark, sf_dir), ["user_id", "cycle_id"]
    return rounded(daily.one_to_one(t["cycles"].select(*keys, "strain"), t["recovery"].select(*keys, "recovery_score"), keys))


#: Columns that events leave empty, filled from a number of the row.
_EMPTY = {
    "cycles": ("cycle_id % 50", "timezone_offset kilojoule average_heart_rate max_heart_rate"),
    "recovery": ("cycle_id % 30", "user_calibrating spo2_percentage skin_temp_celsius"),
    "sleep": ("cast(sleep_id as bigint) % 40", " ".join(c for c in daily._SLEEP if c not in ("total_in_bed_hours", "sleep_debt_need_hours", "respiratory_rate"))),
}


def _filled(table: str, base: str | None = None) -> dict[str, str]:
    """Each empty column's expression, the same in both dialects."""
    number, names = _EMPTY[table]
    number, kinds = base or number, {n: k for n, _, k in SILVER[table]}
    forms = {"string": "concat('+', cast({b} + {i} as varchar(20)))", "int": "cast({b} + {i} as int)", "bool": "({b} + {i}) % 2 = 0"}
    return {n: forms.get(kinds[n], "cast({b} + {i} as double) + cast(0.25 as double)").format(b=f"({number})", i=i) for i, n in enumerate(names.split())}


_STATE = "case when d.cycle_id % 10 = 9 then 'PENDING_SCORE' when d.cycle_id % 10 = 8 then 'UNSCORABLE' else 'SCORED' end"
_ALL = [
    *[f"{x} as {'cycle_' if n != 'timezone_offset' else ''}{n}" for n, x in _filled("cycles", "d.cycle_id % 50").items()],
    *[f"case when r.cycle_id is not null then {x} end as {n}" for n, x in _filled("recovery", "d.cycle_id % 30").items()],
    *[f"case when d.sleep_id is not null then {x} end as {n}" for n, x in _filled("sleep", "cast(d.sleep_id as bigint) % 40").items()],
    f"case when r.cycle_id is not null then {_STATE} end as recovery_score_state", f"case when d.sleep_id is not null then {_STATE} end as sleep_score_state",
]


@query(DAILY + f"select d.*, {', '.join(_ALL)} from daily d left join recovery r using (cycle_id)")
def daily_columns(spark, sf_dir):
    """All forty columns of the daily summary, none of them empty."""
    t = silver(spark, sf_dir)
    for n in _EMPTY:
        t[n] = t[n].withColumns({c: F.expr(x) for c, x in _filled(n).items()})
    return _plain(rounded(daily.daily_summary(t["cycles"], t["recovery"], t["sleep"], t["workouts"])))


@query(MART + f", led as (select *, lead(recovery_score) over w as target, lead(cycle_id) over w as target_cycle_id from mart window w as (partition by user_id order by start_at, cycle_id)) select user_id, cycle_id, {', '.join(features.FEATURES)}, target::double as target, target_cycle_id, (target <= 33)::int as low_recovery from led where target is not null")
def supervised_features(spark, sf_dir):
    """Training pairs with all twelve features."""
    pairs = supervised.supervised_pairs(features.mart_daily_features(_daily(spark, sf_dir)))
    return rounded(pairs.select("user_id", "cycle_id", *features.FEATURES, "target", "target_cycle_id", "low_recovery"))


@query(ROBUST + ", cuts as (select user_id, quantile_disc(day, 0.75) as cut from history group by 1) select user_id, cycle_id, " + ", ".join(f"round(z_{c}, 6) as z_{c}" for c in WATCHED) + ", is_anomaly from robust join history h using (user_id, cycle_id) join cuts using (user_id) where h.day > cut")
def scored_new_days(spark, sf_dir):
    """The last quarter of every nation's days as new rows after the tail of
    those before them."""
    h = nation_history(spark, sf_dir)
    cut = h.groupBy("user_id").agg(F.expr("percentile_disc(0.75) within group (order by datediff(day, date '1990-01-01'))").alias("__cut"))
    parted = h.join(cut, "user_id").withColumn("__new", F.datediff("day", F.lit("1990-01-01").cast("date")) > F.col("__cut"))
    out = anomaly.score_new(parted.where(~F.col("__new")).select(*h.columns), parted.where("__new").select(*h.columns), floors=WATCHED)
    return rounded(out.select("user_id", "cycle_id", *[f"z_{c}" for c in WATCHED], "is_anomaly"))


# ---------------------------------------------------------------- publishing
@query(MART + "select f.format, m.* from mart m, (values ('parquet'), ('csv')) f(format)")
def published_mart(spark, sf_dir):
    """The mart rebuilt twice in a store, seen as a view, exported in both
    formats and read back."""
    root = _fresh(spark, "published")
    store = Store(spark, f"{root}/gold")
    for _ in range(2):
        store.rebuild("pulsegrain_mart", features.mart_daily_features(_daily(spark, sf_dir)))
    store.register_views()
    mart = spark.sql("select * from pulsegrain_mart")
    sources.export_parquet(mart, f"{root}/parquet")
    sources.export_csv(mart, f"{root}/csv")
    back = {"parquet": spark.read.parquet(f"{root}/parquet"), "csv": sources.read_csv(spark, f"{root}/csv", mart.schema)}
    out = back["parquet"].withColumn("format", F.lit("parquet")).unionByName(back["csv"].withColumn("format", F.lit("csv")))
    return _plain(rounded(out))
