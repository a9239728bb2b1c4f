"""Queries of streams, transactions and the daily update: what they leave in
tables, from files and stores that each run makes anew in the shared folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import learn, serving
from ..operators.tables import Store
from ..schemas import RECORD_TYPES, SILVER
from ..scratch import scratch_dir
from ..streaming import daily_rollup, run_available
from .inputs import nation_history, nation_pairs, silver
from .oracle import HISTORY, MART, SHAPES
from .registry import _plain, query, rounded


def _fresh(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- stream to gold
def _records(df: DataFrame, table: str) -> DataFrame:
    """One column `value`: silver rows as landed records, required leaves filled."""
    time = F.coalesce(*[F.col(c) for c in ("updated_at", "start_at") if c in df.columns])
    spare = {"ts": time, "string": F.lit("SCORED"), "bool": F.lit(False)}

    def leaf(name: str, path: str, kind: str):
        c = F.col(name)
        if not path.startswith("score.") and (table, name) != ("cycles", "end_at") and kind in spare:
            c = F.coalesce(c, spare[kind])
        if kind == "ts":
            return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        return (c * 3600000.0 if kind == "hours" else c).cast("string")

    tree: dict = {}
    for name, path, kind in SILVER[table]:
        at = tree
        *outer, last = path.split(".")
        for part in outer:
            at = at.setdefault(part, {})
        at[last] = leaf(name, path, kind)
    struct = lambda t: F.struct(*[(struct(v) if isinstance(v, dict) else v).alias(k) for k, v in t.items()])
    return df.select(F.to_json(struct(tree)).alias("value"))


_UNSCORED = "case when cycle_id%10>=8 then null else {} end"
_STREAMED = MART.replace("round(value/100.0,4) as sleep_debt_need_hours", _UNSCORED.format("round(value/100.0,4)") + " as sleep_debt_need_hours")


@query(_STREAMED + "select m.*, (select count(*) from cycles where cycle_id % 50 = 0) * 2 as rejects, 1 as last_batch from mart m")
def stream_gold(spark, sf_dir):
    """The mart after two batches of a stream over landed files. In the first a
    fifth of the cycles is pending; the second corrects these and has lines that
    are no records or have no key."""
    root, t = _fresh(spark, "stream"), silver(spark, sf_dir)
    late = F.col("cycle_id") % 5 == 0
    first = t["cycles"].withColumns({"score_state": F.when(late, "PENDING_SCORE").otherwise(F.col("score_state")), "strain": F.when(~late, F.col("strain")), "updated_at": F.when(late, F.col("start_at")).otherwise(F.col("updated_at"))})
    store = Store(spark, f"{root}/gold", buckets=8)
    for n in RECORD_TYPES:
        _records(first if n == "cycles" else t[n], n).write.text(f"{root}/landing/{n}/pull=1")
    run_available(spark, f"{root}/landing", store, f"{root}/checkpoint")
    bad = t["cycles"].where("cycle_id % 50 = 0").select(F.explode(F.array(F.concat(F.lit("{ broken "), "cycle_id"), F.concat(F.lit('{"user_id": '), "cycle_id", F.lit("}")))).alias("value"))
    _records(t["cycles"].where(late), "cycles").unionByName(bad).write.text(f"{root}/landing/cycles/pull=2")
    run_available(spark, f"{root}/landing", store, f"{root}/checkpoint")
    rejects = store.read("rejects")
    out = _plain(rounded(store.read("mart_daily_features")))
    return out.withColumns({"rejects": F.lit(0 if rejects is None else rejects.count()).cast("long"), "last_batch": F.lit(store.manifest()["batches"]["landing"])})


# ---------------------------------------------------------------- late rows
_PARTS = """, parts as (
  select *, case when cycle_id % 7 = 0 and start_at < timestamp '2024-01-21' then 3 when start_at < timestamp '2024-01-11' then 1 when start_at < timestamp '2024-01-21' then 2 else 3 end as part from cycles
),
marks as (select max(start_at) filter (part < 3) - interval 2 day as before_last, max(start_at) - interval 2 day as at_last from parts),
kept as (select p.* from parts p, marks where part < 3 or date_trunc('day', start_at) + interval 1 day > before_last)
"""


@query(SHAPES + _PARTS + "select cast(start_at as date) as day, count(*) as cycles, round(avg(strain), 6) as avg_strain from kept group by 1 having cast(start_at as date) + interval 1 day <= (select at_last from marks)")
def late_rollup(spark, sf_dir):
    """Days of event time by a stream in append mode, over three landings. A
    seventh of the first twenty days lands last: what is late by less than the
    watermark's two days counts, the rest is dropped by the state store; days
    that the watermark has not passed are not out yet."""
    root, c = _fresh(spark, "late"), silver(spark, sf_dir)["cycles"].select("cycle_id", "start_at", "strain", "kilojoule")
    day = lambda d: F.lit(dt.datetime(2024, 1, d)).cast("timestamp_ntz").cast("timestamp")
    late = (F.col("cycle_id") % 7 == 0) & (F.col("start_at") < day(21))
    part = F.when(late, 3).when(F.col("start_at") < day(11), 1).when(F.col("start_at") < day(21), 2).otherwise(3)
    for i in (1, 2, 3):
        c.where(part == i).write.parquet(f"{root}/landing/part={i}")
        stream = spark.readStream.schema(c.schema).option("recursiveFileLookup", True).parquet(f"{root}/landing")
        run = daily_rollup(stream, "2 days").writeStream.format("parquet").outputMode("append").option("path", f"{root}/days").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        run.awaitTermination()
    out = spark.read.parquet(f"{root}/days")
    return rounded(out.select(F.to_date("day").alias("day"), "cycles", "avg_strain"))


# ---------------------------------------------------------------- daily update
def _day(k: int, until: str) -> str:
    """Histories, fits and latest cycles of everything up to a day."""
    return f""", h{k} as (select *, lead(recovery_score) over (partition by user_id order by day) as next_score, lead(day) over (partition by user_id order by day) as next_day from history where day <= {until}),
f{k} as (select user_id, avg(recovery_score) as m, coalesce(nullif(stddev_pop(recovery_score), 0), 1) as s, avg(next_score) as b, count(*) as n, covar_pop(recovery_score, next_score) as c,
  count(*) >= 90 and date_diff('day', min(day), max(next_day)) >= 89 as ready from h{k} where next_score is not null group by 1),
l{k} as (select user_id, arg_max(cycle_id, day) as cycle_id, arg_max(recovery_score, day) as x, max(day) as day, {until} - max(day) <= 2 as fresh from h{k} group by 1)"""


_POINT = "least(100.0, greatest(0.0, {f}.b + {f}.c * {f}.n / {f}.s / ({f}.n + 10) * ({l}.x - {f}.m) / {f}.s))"
_UPDATE = HISTORY + ", ends as (select max(day) as last from history)" + _day(1, "((select last from ends) - 1)") + _day(2, "(select last from ends)") + f""",
one as (select l1.user_id, l1.cycle_id, l1.day, case when fresh and ready then {_POINT.format(f='f1', l='l1')} end as predicted, case when not fresh then 'stale_or_future_features' when not ready then 'insufficient_history' else 'initial_training' end as reason from l1 join f1 using (user_id)),
outcome as (select o.user_id, h2.recovery_score as actual from one o join h2 on h2.user_id = o.user_id and h2.day > o.day where o.predicted is not null),
two0 as (select l2.user_id, l2.cycle_id, case when not fresh then 'stale_or_future_features' when not ready then 'insufficient_history' when o.predicted is not null and o.cycle_id = l2.cycle_id then 'already_predicted'
  when o.predicted is null then 'initial_training' when abs(o.predicted - y.actual) > 15 then 'emergency' else 'stable' end as reason from l2 join f2 using (user_id) join one o using (user_id) left join outcome y using (user_id)),
two as (select t.*, case when t.reason in ('initial_training', 'emergency') then {_POINT.format(f='f2', l='l2')} when t.reason = 'stable' then {_POINT.format(f='f1', l='l2')} end as predicted,
  case when t.reason = 'emergency' then 2 when t.reason in ('initial_training', 'stable') then 1 end as version from two0 t join f1 using (user_id) join f2 using (user_id) join l2 using (user_id)),
runs as (select 1 as run, user_id, cycle_id, reason, predicted, case when predicted is not null then 1 end as version from one union all select 2, user_id, cycle_id, reason, predicted, version from two)
"""


@query(_UPDATE + """select run, user_id, cycle_id, case when predicted is not null then 'predicted' when reason = 'already_predicted' then reason else 'skipped' end as status, nullif(reason, 'already_predicted') as reason,
case when predicted is not null then reason in ('initial_training', 'emergency') end as updated, version::int as model_version, round(predicted, 6) as predicted from runs""")
def daily_update(spark, sf_dir):
    """The update of every nation on the last two days of its history: settled,
    then trained, kept or skipped, in one transaction a day."""
    h = nation_history(spark, sf_dir)
    last = h.agg(F.max("day")).first()[0]
    if last is None:
        raise ValueError("no history")
    store, out = Store(spark, _fresh(spark, "updates")), None
    for run, day in ((1, last - dt.timedelta(days=1)), (2, last)):
        now = dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc)
        got = serving.update_daily(store, h.where(F.col("day") <= F.lit(day)), now, data_kind="orders", features=("recovery_score",), replicates=100).withColumn("run", F.lit(run))
        out = got if out is None else out.unionByName(got)
    return rounded(out.select("run", "user_id", "cycle_id", "status", "reason", "updated", "model_version", "predicted"))


# ---------------------------------------------------------------- sliding training
_W90 = "over (partition by user_id order by day range between interval 90 day preceding and interval 1 day preceding)"


@query(HISTORY + f""", w as (select user_id, cycle_id, recovery_score as x, count(*) {_W90} as n, avg(recovery_score) {_W90} as m, coalesce(nullif(stddev_pop(recovery_score) {_W90}, 0), 1) as s, avg(target) {_W90} as b, covar_pop(recovery_score, target) {_W90} as c from pairs)
select user_id, cycle_id, round(least(100.0, greatest(0.0, b + c * n / s / (n + 10) * (x - m) / s)), 6) as predicted from w where n >= 14""")
def sliding_forecasts(spark, sf_dir):
    """Every day's forecast by a ridge of the 90 days before it, if 14 of them
    have pairs."""
    return rounded(learn.sliding_forecasts(nation_pairs(spark, sf_dir), ("recovery_score",), least=14).select("user_id", "cycle_id", "predicted"))
