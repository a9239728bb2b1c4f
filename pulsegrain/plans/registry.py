"""Queries by name, and DuckDB SQL that gives the same rows.

Doubles are rounded to six places on both sides, because sums differ in their
last digits with the order of addition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import elapsed_ms
from ..operators import anomaly, contracts, daily, explore, features, folds, intervals, learn, monitor, serving, supervised, tables
from ..operators.flatten import flatten
from ..schemas import RECORDS, SCORE_STATES
from . import inputs
from .inputs import nation_folds, nation_history, nation_pairs, silver
from .oracle import DAILY, FOLDS, FORECASTS, HISTORY, MART, SHAPES, TAIL

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema])


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = silver(spark, sf_dir)
    return daily.daily_summary(t["cycles"], t["recovery"], t["sleep"], t["workouts"])


_DAILY = [
    "cycle_id", "user_id", "start_at", "end_at", "cycle_score_state", "cycle_strain", "recovery_score", "resting_heart_rate", "hrv_rmssd_milli", "sleep_id", "total_in_bed_hours", "sleep_debt_need_hours", "respiratory_rate",
    "workout_count", "workout_total_strain", "workout_max_strain", "workout_total_kilojoule", "workout_total_duration_hours",
]
_TIMES = ("start_at", "end_at", "updated_at")


def _plain(df: DataFrame) -> DataFrame:
    """Times without a zone, as the input has them."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in _TIMES else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- joins and windows
@query(DAILY + "select workout_id, user_id, cycle_id from place")
def workout_assignment(spark, sf_dir):
    t = silver(spark, sf_dir)
    return daily.assign_workouts(t["workouts"], t["cycles"]).select("workout_id", "user_id", "cycle_id")


@query(DAILY + "select cycle_id, user_id, workout_count, workout_total_strain, workout_max_strain, workout_total_kilojoule, workout_total_duration_hours from effort")
def workout_by_cycle(spark, sf_dir):
    t = silver(spark, sf_dir)
    return rounded(daily.workouts_by_cycle(t["cycles"], daily.assign_workouts(t["workouts"], t["cycles"]))).select("cycle_id", "user_id", "workout_count", "workout_total_strain", "workout_max_strain", "workout_total_kilojoule", "workout_total_duration_hours")


@query(DAILY + "select " + ", ".join(_DAILY) + " from daily")
def daily_summary(spark, sf_dir):
    return _plain(rounded(_daily(spark, sf_dir).select(*_DAILY)))


@query(MART + "select * from mart")
def mart_daily_features(spark, sf_dir):
    return _plain(rounded(features.mart_daily_features(_daily(spark, sf_dir))))


@query(MART + "select m.*, c.end_at, r.resting_heart_rate, s.respiratory_rate from mart m join cycles c on c.cycle_id=m.cycle_id left join recovery r on r.cycle_id=m.cycle_id left join night s on s.cycle_id=m.cycle_id")
def model_history(spark, sf_dir):
    t = silver(spark, sf_dir)
    mart = features.mart_daily_features(daily.daily_summary(t["cycles"], t["recovery"], t["sleep"], t["workouts"]))
    return _plain(rounded(daily.model_history(mart, t["cycles"], t["recovery"], t["sleep"]).drop("skin_temp_celsius", "spo2_percentage")))


@query(SHAPES + ", r as (select *, row_number() over (partition by cycle_id order by updated_at desc, sleep_id desc) as rk from sleep) select cycle_id, user_id, sleep_id, is_nap, updated_at from r where rk=1")
def latest_by_key(spark, sf_dir):
    return _plain(tables.latest_by_key(silver(spark, sf_dir)["sleep"], ["cycle_id"], ["updated_at", "sleep_id"]).select("cycle_id", "user_id", "sleep_id", "is_nap", "updated_at"))


@query(SHAPES + "select cycle_id, user_id, case when cycle_id%2=0 then strain+1 else strain end as strain from cycles where cycle_id%3 != 1 union all select cycle_id, user_id, strain+1 from cycles where cycle_id%3=1 and cycle_id%2=0")
def upsert_merge(spark, sf_dir):
    c = silver(spark, sf_dir)["cycles"].select("cycle_id", "user_id", "strain")
    old = c.where("cycle_id % 3 != 1")
    new = c.where("cycle_id % 2 = 0").withColumn("strain", F.col("strain") + 1)
    return tables.upsert(old, new, ["cycle_id"])


@query("select event_id as cycle_id, user_id, case when event_type='click' then try_cast(json_extract_string(props,'$.k') as int) end as average_heart_rate, case when event_type='click' then round(value,6) end as strain, case when event_type='click' then 'SCORED' else 'PENDING_SCORE' end as score_state from events")
def flatten_props(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    scored = F.col("event_type") == "click"
    score = F.struct(F.col("value").cast("string").alias("strain"), F.lit(None).cast("string").alias("kilojoule"), F.get_json_object("props", "$.k").alias("average_heart_rate"), F.lit(None).cast("string").alias("max_heart_rate"))
    raw = F.to_json(F.struct(F.col("event_id").alias("id"), "user_id", F.when(scored, "SCORED").otherwise("PENDING_SCORE").alias("score_state"), score.alias("score")))
    flat = flatten(e.select(F.from_json(raw, RECORDS["cycles"]).alias("r")).select("r.*"), "cycles")
    return rounded(flat.select("cycle_id", "user_id", "average_heart_rate", "strain", "score_state"))


# ---------------------------------------------------------------- exploration
@query(DAILY + "select dayname(start_at) as weekday, cast(isodow(start_at)-1 as int) as weekday_order, round(avg(recovery_score),6) as avg_recovery, round(avg(cycle_strain),6) as avg_strain, round(avg(total_in_bed_hours),6) as avg_in_bed, count(*) as n from daily where recovery_score is not null group by 1, 2")
def recovery_by_weekday(spark, sf_dir):
    return rounded(explore.weekday_profile(_daily(spark, sf_dir)))


@query(DAILY + "select strftime(start_at,'%Y-%m') as month, round(avg(recovery_score),6) as avg_recovery, round(avg(hrv_rmssd_milli),6) as avg_hrv, round(avg(cycle_strain),6) as avg_strain, round(avg(total_in_bed_hours),6) as avg_in_bed, count(*) as n from daily where recovery_score is not null group by 1 order by 1 desc limit 12")
def monthly_trend(spark, sf_dir):
    return rounded(explore.monthly_trend(_daily(spark, sf_dir)))


@query(SHAPES + "select sport_name, count(*) as n, round(avg(strain),6) as avg_strain, round(avg(date_diff('millisecond',start_at,end_at)/cast(60000 as double)),6) as avg_minutes, round(avg(average_heart_rate),6) as avg_heart_rate, round(sum(kilojoule),6) as total_kilojoule from workouts where sport_name is not null group by 1 order by 2 desc, 1 limit 10")
def by_sport(spark, sf_dir):
    return rounded(explore.sport_profile(silver(spark, sf_dir)["workouts"]))


@query(DAILY + ", l as (select *, lag(cycle_strain) over (partition by user_id order by start_at, cycle_id) as p from daily where recovery_score is not null) select case when p<8 then 'Low (<8)' when p<12 then 'Medium (8-12)' when p<16 then 'High (12-16)' else 'Very High (16+)' end as strain_band, round(avg(recovery_score),6) as avg_recovery, count(*) as n from l where p is not null group by 1")
def strain_bucket_effect(spark, sf_dir):
    return rounded(explore.strain_effect(_daily(spark, sf_dir)))


@query(DAILY + "select case when total_in_bed_hours<6 then '< 6 hrs' when total_in_bed_hours<7 then '6-7 hrs' when total_in_bed_hours<8 then '7-8 hrs' when total_in_bed_hours<9 then '8-9 hrs' else '9+ hrs' end as sleep_band, round(avg(recovery_score),6) as avg_recovery, round(avg(hrv_rmssd_milli),6) as avg_hrv, count(*) as n from daily where total_in_bed_hours is not null and recovery_score is not null group by 1")
def sleep_bucket_effect(spark, sf_dir):
    return rounded(explore.sleep_effect(_daily(spark, sf_dir)))


@query(DAILY + "(select cycle_id, user_id, start_at, recovery_score, 'top' as side from daily where recovery_score is not null order by recovery_score desc, cycle_id limit 5) union all (select cycle_id, user_id, start_at, recovery_score, 'bottom' from daily where recovery_score is not null order by recovery_score, cycle_id limit 5)")
def top_bottom(spark, sf_dir):
    return _plain(explore.extremes(_daily(spark, sf_dir)))


@query(SHAPES + "select sport_name as value, count(*) as n from workouts group by 1 union all select cast(is_nap as varchar), count(*) from sleep group by 1")
def value_counts(spark, sf_dir):
    t = silver(spark, sf_dir)
    return explore.union_all([explore.value_counts(t["workouts"], "sport_name", 10), explore.value_counts(t["sleep"], "is_nap")])


_PROFILED = ["cycle_id", "end_at", "strain", "score_state"]


@query(SHAPES + " union all ".join(f"select '{c}' as column_name, count(*) as n_rows, count(*) filter ({c} is null) as nulls, round(count(*) filter ({c} is null)*100.0/count(*),6) as null_percent, min(start_at) as first_at, max(start_at) as last_at from cycles" for c in _PROFILED))
def table_profile(spark, sf_dir):
    out = explore.table_profile(silver(spark, sf_dir)["cycles"].select(*_PROFILED, "start_at"), "start_at").where("column_name != 'start_at'")
    return rounded(out).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_at", "last_at")})


_NUMBERS = ["recovery_score", "cycle_strain", "hrv_rmssd_milli"]


@query(DAILY + " union all ".join(f"select '{c}' as column_name, count({c}) as n, round(avg({c}),6) as mean, round(stddev_samp({c}),6) as std, round(cast(min({c}) as double),6) as min, round(quantile_cont(cast({c} as double),0.25),6) as q25, round(quantile_cont(cast({c} as double),0.5),6) as q50, round(quantile_cont(cast({c} as double),0.75),6) as q75, round(cast(max({c}) as double),6) as max from daily" for c in _NUMBERS))
def numeric_summary(spark, sf_dir):
    return rounded(explore.numeric_summary(_daily(spark, sf_dir), _NUMBERS))


_OVERLAP = ["cycles", "recovery", "sleep"]
#: Sleep ids of the sleep table and of the daily summary, as a second key.
_SLEEPS = " union all select 'sleep_id:sleep', 'sleep_id:sleep', count(distinct sleep_id) from sleep union all select 'sleep_id:daily', 'sleep_id:daily', count(distinct sleep_id) from daily union all select 'sleep_id:sleep', 'sleep_id:daily', count(*) from (select sleep_id from sleep intersect select sleep_id from daily)"


@query(DAILY + " union all ".join([f"select '{a}' as left_table, '{a}' as right_table, count(distinct cycle_id) as n from {a}" for a in _OVERLAP] + [f"select '{a}', '{b}', count(*) from (select cycle_id from {a} intersect select cycle_id from {b})" for i, a in enumerate(_OVERLAP) for b in _OVERLAP[i + 1 :]]) + _SLEEPS)
def key_overlap(spark, sf_dir):
    t = silver(spark, sf_dir)
    sleeps = {"sleep_id:sleep": t["sleep"], "sleep_id:daily": _daily(spark, sf_dir)}
    return explore.key_overlap({n: t[n] for n in _OVERLAP}, "cycle_id").unionByName(explore.key_overlap(sleeps, "sleep_id"))


_KEYED = (("cycles", "cycle_id"), ("recovery", "cycle_id"), ("sleep", "sleep_id"), ("workouts", "workout_id"))


@query(DAILY + " union all ".join(f"select '{n}' as table_name, count(*) as n_rows, count(distinct {k}) as n_keys from {n}" for n, k in (*_KEYED, ("daily", "cycle_id"))))
def key_audit(spark, sf_dir):
    t = silver(spark, sf_dir)
    return explore.key_audit({n: (t[n], k) for n, k in _KEYED} | {"daily": (_daily(spark, sf_dir), "cycle_id")})


@query(DAILY + ", s as (select min(cycle_strain) as lo, max(cycle_strain) as hi, round(avg(cycle_strain),6) as mean from daily) select cast(least(29, floor((cycle_strain-lo)*30/(hi-lo))) as int) as bin, round(lo+cast(least(29, floor((cycle_strain-lo)*30/(hi-lo))) as int)*(hi-lo)/30,6) as bin_start, count(*) as n, mean from daily, s where cycle_strain is not null group by 1, 2, 4")
def histogram30(spark, sf_dir):
    return rounded(explore.histogram(_daily(spark, sf_dir), "cycle_strain", 30))


@query(DAILY + ", l as (select user_id, recovery_score as x, lag(recovery_score) over (partition by user_id order by start_at, cycle_id) as y from daily), c as (select user_id, corr(x, y) as c, count(y) as pairs, count(x+y) as known from l group by 1) select user_id, case when known>2 and not isnan(c) then round(c,6) end as correlation, pairs from c")
def lag_correlation(spark, sf_dir):
    d = _daily(spark, sf_dir)
    out = explore.lag_correlation(d, "recovery_score")
    return rounded(out.select("user_id", F.when(F.col("both") > 2, F.nanvl("correlation", F.lit(None).cast("double"))).alias("correlation"), "pairs"))


@query(DAILY + "select user_id, count(p) as pairs from (select user_id, lag(recovery_score) over (partition by user_id order by start_at, cycle_id) as p from daily) group by 1")
def lag_pairs(spark, sf_dir):
    return explore.lag_correlation(_daily(spark, sf_dir), "recovery_score").select("user_id", "pairs")


# ---------------------------------------------------------------- contracts
@query(DAILY + "select cycle_id, user_id, cycle_strain from daily where cycle_strain is not null and (cycle_strain<5 or cycle_strain>20)")
def range_violations(spark, sf_dir):
    return contracts.range_violations(_daily(spark, sf_dir), "cycle_strain", 5.0, 20.0).select("cycle_id", "user_id", "cycle_strain")


def _seeded(spark, sf_dir) -> DataFrame:
    """Cycles with broken rows among them."""
    c = silver(spark, sf_dir)["cycles"]
    i = F.col("cycle_id")
    c = c.withColumns({"strain": F.when(i % 11 == 0, -F.col("strain") - 0.1).otherwise(F.col("strain")), "score_state": F.when(i % 13 == 0, "LATE").when(i % 29 == 0, None).otherwise(F.col("score_state"))})
    return c.unionByName(c.where(i % 23 == 0))


@query(SHAPES + """, c0 as (select cycle_id, start_at, case when cycle_id%11=0 then -strain-0.1 else strain end as strain, case when cycle_id%13=0 then 'LATE' when cycle_id%29=0 then null else score_state end as score_state from cycles),
c as (select * from c0 union all select * from c0 where cycle_id%23=0)
select * from (select 'strain' as "column", 'range' as rule, count(*) as violations from c where strain<0 union all select 'score_state', 'allowed', count(*) from c where score_state not in ('SCORED','PENDING_SCORE','UNSCORABLE')
union all select 'score_state', 'not_null', count(*) from c where score_state is null union all select 'cycle_id', 'unique', count(*) from (select cycle_id from c group by 1 having count(*)>1)) where violations>0""")
def contract_report(spark, sf_dir):
    rules = {("strain", "range"): contracts.outside(F.col("strain"), 0.0, None), ("score_state", "allowed"): F.coalesce(~F.col("score_state").isin(*SCORE_STATES), F.lit(False)), ("score_state", "not_null"): F.col("score_state").isNull()}
    return contracts.rules_report(_seeded(spark, sf_dir), "cycles", "cycle_id", rules).select("column", "rule", "violations")


@query(SHAPES + "select cycle_id, user_id, sleep_id from sleep s where not exists (select 1 from recovery r where r.cycle_id=s.cycle_id and r.user_id=s.user_id)")
def orphan_keys(spark, sf_dir):
    t = silver(spark, sf_dir)
    return contracts.orphan_keys(t["sleep"], t["recovery"], ["cycle_id", "user_id"]).select("cycle_id", "user_id", "sleep_id")


@query(SHAPES + "select cycle_id, count(*) as n from sleep group by 1 having count(*)>1")
def duplicate_keys(spark, sf_dir):
    return contracts.duplicate_keys(silver(spark, sf_dir)["sleep"], ["cycle_id"]).withColumnRenamed("count", "n")


# ---------------------------------------------------------------- models
@query(HISTORY + "select user_id, cycle_id, target, target_cycle_id, low_recovery from pairs")
def supervised_pairs(spark, sf_dir):
    return nation_pairs(spark, sf_dir).select("user_id", "cycle_id", "target", "target_cycle_id", "low_recovery")


@query(HISTORY + "select user_id, count(*) as pairs, cast(date_diff('day', min(day), max(target_day)) as double) as days, count(*)>=90 and date_diff('day', min(day), max(target_day))>=89 as ready from pairs group by 1")
def readiness(spark, sf_dir):
    return rounded(supervised.readiness(nation_pairs(spark, sf_dir)))


@query(FOLDS + "select user_id, cast(fold as int) as fold, role, count(*) as n, min(cycle_id) as first_cycle, max(cycle_id) as last_cycle from folds group by 1, 2, 3")
def walk_forward_folds(spark, sf_dir):
    return folds.fold_summary(nation_folds(spark, sf_dir))


#: What is watched in the nation history, and the least scale of each.
WATCHED = {"total": 1000.0, "recovery_score": 1.0, "prior": 1.0}
_Z = ", ".join(f"case when count({c}) over w >= 14 then abs({c} - median({c}) over w) / greatest(1.4826 * mad({c}) over w, cast({floor} as double)) end as z_{c}" for c, floor in WATCHED.items())
ROBUST = HISTORY + f", z as (select user_id, cycle_id, {_Z} from history window w as (partition by user_id order by day rows between 28 preceding and 1 preceding)), robust as (select *, " + " or ".join(f"coalesce(z_{c} > 3.5, false)" for c in WATCHED) + " as is_anomaly from z)"


@query(ROBUST + "select user_id, cycle_id, " + ", ".join(f"round(z_{c}, 6) as z_{c}" for c in WATCHED) + ", is_anomaly from robust")
def robust_anomaly(spark, sf_dir):
    """Every nation's days against the 28 before them; some hundreds are flagged."""
    out = anomaly.robust_scores(nation_history(spark, sf_dir), floors=WATCHED)
    return rounded(out.select("user_id", "cycle_id", *[f"z_{c}" for c in WATCHED], "is_anomaly"))


_HF = inputs.HISTORY_FEATURES


@query(FOLDS + ", tr as (select * from folds where role='train'), med as (select user_id, fold, " + ", ".join(f"coalesce(quantile_cont({c},0.5),0) as m_{c}" for c in _HF) + " from tr group by 1, 2), f as (select tr.user_id, tr.fold, target, " + ", ".join(f"coalesce({c}, m_{c}) as {c}" for c in _HF) + " from tr join med using (user_id, fold)) select user_id, cast(fold as int) as fold, count(*) as n, " + ", ".join(f"round(avg({c}),6) as mean_{c}, round(stddev_pop({c}),6) as scale_{c}" for c in _HF) + " from f group by 1, 2")
def impute_scale(spark, sf_dir):
    prep = learn.fold_models(nation_folds(spark, sf_dir), _HF)
    return rounded(prep.select("user_id", "fold", "n", *[x for i, c in enumerate(_HF) for x in (F.col("means")[i].alias(f"mean_{c}"), F.col("scales")[i].alias(f"scale_{c}"))]))


@query(HISTORY + ", z as (select user_id, target, (recovery_score - avg(recovery_score) over u)/coalesce(nullif(stddev_pop(recovery_score) over u, 0), 1) as a, (total - avg(total) over u)/coalesce(nullif(stddev_pop(total) over u, 0), 1) as b from pairs window u as (partition by user_id)) select user_id, count(*) as n, round(sum(target),6) as sum_y, round(sum(a*target),4) as za_y, round(sum(b*target),4) as zb_y, round(sum(a*b),4) as za_zb from z group by 1")
def ridge_gram(spark, sf_dir):
    pairs, keys, cols = nation_pairs(spark, sf_dir), ["user_id"], ("recovery_score", "total")
    g = learn.gram(learn.standardise(pairs, learn.fit_preprocessing(pairs, keys, cols), keys, cols), keys, 2)
    r4 = lambda c: F.round(c, 4)
    return g.select("user_id", "n", F.round("sum_y", 6).alias("sum_y"), r4(F.col("sum_zy")[0]).alias("za_y"), r4(F.col("sum_zy")[1]).alias("zb_y"), r4(F.col("sum_zz")[1]).alias("za_zb"))


@query(FOLDS + ", t as (select user_id, fold, target as a, recovery_score as p from folds where role='test') select user_id, cast(fold as int) as fold, count(*) as n, round(avg(abs(p-a)),6) as mae, round(avg(abs((p-a)/nullif(a,0)))*100,6) as mape, count(*) filter (a=0) as mape_excluded_zeros, round(case when min(a)=max(a) then (case when sum((p-a)*(p-a))=0 then 1.0 else 0.0 end) else 1-sum((p-a)*(p-a))/(count(*)*var_pop(a)) end,6) as r2 from t group by 1, 2")
def fold_metrics(spark, sf_dir):
    tested = folds.test_rows(nation_folds(spark, sf_dir))
    return rounded(supervised.regression_metrics(monitor.persistence_forecast(tested), ["user_id", "fold"]))


@query(FOLDS + """, t as (select user_id, fold, low_recovery as y, 1-recovery_score/cast(101 as double) as p from folds where role='test'),
r as (select *, rank() over (partition by user_id, fold order by p) + (count(*) over (partition by user_id, fold, p) - 1)/cast(2 as double) as rk from t)
select user_id, cast(fold as int) as fold, round(case when count(*) filter (p>=0.5)>0 then count(*) filter (p>=0.5 and y=1)/cast(count(*) filter (p>=0.5) as double) else 0.0 end,6) as precision,
round(case when sum(y)>0 then count(*) filter (p>=0.5 and y=1)/cast(sum(y) as double) else 0.0 end,6) as recall, cast(sum(y) as bigint) as positive_count,
round(case when sum(y)>0 and sum(y)<count(*) then (sum(case when y=1 then rk end) - sum(y)*(sum(y)+1)/cast(2 as double))/(sum(y)*(count(*)-sum(y))) end,6) as auc from r group by 1, 2""")
def auc_by_fold(spark, sf_dir):
    tested = folds.test_rows(nation_folds(spark, sf_dir))
    return rounded(supervised.classification_metrics(tested.withColumn("probability", 1 - F.col("recovery_score") / F.lit(101.0)), ["user_id", "fold"]))


@query(FOLDS + ", t as (select user_id, fold, avg(abs(recovery_score-target)) as mae, count(*) as n from folds where role='test' group by 1, 2) select user_id, 'mae' as metric, round(avg(mae),6) as mean, round(stddev_pop(mae),6) as std, count(*) as folds from t group by 1")
def metric_summary(spark, sf_dir):
    tested = folds.test_rows(nation_folds(spark, sf_dir))
    m = supervised.regression_metrics(monitor.persistence_forecast(tested), ["user_id", "fold"])
    return rounded(supervised.metric_summary(supervised.metrics_long(m, ["user_id", "fold"]).where("metric = 'mae'"), ["user_id"]))


@query(HISTORY + TAIL + "select user_id, cast(n as int) as n, round(avg(lo),6) as low_tail, round(avg(hi),6) as high_tail from tails group by 1, 2")
def bootstrap_interval(spark, sf_dir):
    return rounded(_tails(nation_history(spark, sf_dir)))


def _tails(history: DataFrame) -> DataFrame:
    """Tails of the persistence residuals, from blocks that SQL can draw as well."""
    h = history.where("prior is not null")
    start = lambda rep, b, places: ((rep.cast("long") * 7919 + b.cast("long") * 104729 + 31) % 1000003) % places
    r = h.select("user_id", "day", (F.col("recovery_score") - F.col("prior")).alias("residual"))
    return intervals.bootstrap_tails(r, ["day"], replicates=1000, start=start)


def _forecasts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Persistence forecasts; every third is issued after its target began."""
    h = nation_history(spark, sf_dir)
    none = lambda t: F.lit(None).cast(t)
    late = F.when(F.col("cycle_id") % 3 == 0, F.col("start_at") + F.expr("interval 4000 days")).otherwise(F.col("start_at"))
    value = F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.coalesce("prior", "recovery_score")))
    p = h.select("user_id", "cycle_id", F.lit("persistence").alias("model_name"), F.lit(1).alias("model_version"), F.col("start_at").alias("origin_at"), late.alias("created_at"), value.alias("predicted_value"),
                 F.lit(0.0).alias("ci_lower"), F.lit(100.0).alias("ci_upper"), none("bigint").alias("target_cycle_id"), none("double").alias("actual_value"), none("double").alias("error"))
    return p, h


@query(FORECASTS + "select user_id, cycle_id, predicted_value, target_cycle_id, actual_value, error from settled")
def settle_predictions(spark, sf_dir):
    p, h = _forecasts(spark, sf_dir)
    return serving.settle(p, h).select("user_id", "cycle_id", "predicted_value", "target_cycle_id", "actual_value", "error")


@query(FORECASTS + """, e as (select user_id, error, row_number() over (partition by user_id order by day desc) as r from settled where error is not null),
w as (select user_id, count(*) as n_errors, max(case when r=1 then error end) as last_error, avg(case when r<=7 then error end) as bias_7, avg(case when r<=7 then abs(error) end) as mae_7, avg(case when r>7 then abs(error) end) as mae_previous_7 from e where r<=14 group by 1)
select user_id, n_errors, round(bias_7,6) as bias_7, round(mae_7,6) as mae_7, case when abs(last_error)>15 then 'emergency' when n_errors>=7 and abs(bias_7)>5 then 'bias_correction' when n_errors>=14 and mae_7>mae_previous_7+1 then 'drift_correction' when user_id%9>=7 then 'routine' else 'stable' end as reason from w""")
def retrain_decision(spark, sf_dir):
    p, h = _forecasts(spark, sf_dir)
    w = monitor.error_windows(serving.settle(p, h), ["origin_at"]).withColumn("days_since_update", F.col("user_id") % 9)
    return rounded(monitor.retrain_decision(w).select("user_id", "n_errors", "bias_7", "mae_7", "reason"))


@query(FORECASTS + "select user_id, cycle_id, predicted_value from forecasts where cycle_id%2=1")
def first_write_wins(spark, sf_dir):
    p, _ = _forecasts(spark, sf_dir)
    return serving.save_predictions(p.where("cycle_id % 2 = 0"), p).select("user_id", "cycle_id", "predicted_value")


_ROLLED = ", ".join(f"round(avg(abs(error)) over w{n},6) as mae_{n}, round(sqrt(avg(error*error) over w{n}),6) as rmse_{n}, round(avg(error) over w{n},6) as bias_{n}, round(var_pop(error) over w{n},6) as variance_{n}, round(case when var_pop(actual_value) over w{n} > 0 then 1 - avg(error*error) over w{n} / nullif(var_pop(actual_value) over w{n}, 0) end, 4) as r2_{n}" for n in (7, 30))


@query(FORECASTS + f", s as (select * from settled where error is not null) select user_id, cycle_id, {_ROLLED} from s window w7 as (partition by user_id order by day, cycle_id rows between 6 preceding and current row), w30 as (partition by user_id order by day, cycle_id rows between 29 preceding and current row)")
def rolling_error_stats(spark, sf_dir):
    p, h = _forecasts(spark, sf_dir)
    out = monitor.rolling_errors(serving.settle(p, h), (7, 30)).withColumns({f"r2_{n}": F.round(f"r2_{n}", 4) for n in (7, 30)})
    return rounded(out.select("user_id", "cycle_id", *[f"{k}_{n}" for n in (7, 30) for k in ("mae", "rmse", "bias", "variance", "r2")]))


@query(FORECASTS + TAIL + """, ends as (select user_id, avg(lo) as lo, avg(hi) as hi from tails group by 1)
select s.user_id, round(avg(case when actual_value between least(100, greatest(0, predicted_value + lo)) and least(100, greatest(0, predicted_value + hi)) then 1.0 else 0.0 end), 6) as coverage,
round(avg(least(100, greatest(0, predicted_value + hi)) - least(100, greatest(0, predicted_value + lo))), 6) as mean_width, count(*) as n
from settled s join ends e on e.user_id = s.user_id where actual_value is not null group by 1""")
def interval_coverage(spark, sf_dir):
    p, h = _forecasts(spark, sf_dir)
    tails = _tails(h)
    p = intervals.prediction_intervals(p.drop("ci_lower", "ci_upper").withColumn("predicted", F.col("predicted_value")), tails)
    return rounded(monitor.interval_coverage(serving.settle(p, h)).select("user_id", "coverage", "mean_width", "n"))


@query(FORECASTS + ", s as (select user_id, avg(error) as m, stddev_samp(error) as d from settled where error is not null group by 1) select t.user_id, t.cycle_id, t.error from settled t join s on t.user_id=s.user_id where abs(t.error-s.m) > 2*s.d")
def error_outliers(spark, sf_dir):
    p, h = _forecasts(spark, sf_dir)
    return monitor.error_outliers(serving.settle(p, h)).select("user_id", "cycle_id", "error")


@query(DAILY + ", r as (select cycle_id, user_id, round(avg(cycle_strain) over w7,6) as cycle_strain_7_avg, round(avg(cycle_strain) over w30,6) as cycle_strain_30_avg, round(stddev_samp(cycle_strain) over w7,6) as spread_7 from daily window w7 as (partition by user_id order by start_at, cycle_id rows between 6 preceding and current row), w30 as (partition by user_id order by start_at, cycle_id rows between 29 preceding and current row)) select * from r")
def rolling_statistics(spark, sf_dir):
    out = features.rolling_statistics(_daily(spark, sf_dir), "cycle_strain")
    return rounded(out.select("cycle_id", "user_id", "cycle_strain_7_avg", "cycle_strain_30_avg", F.col("cycle_strain_7_stddev_samp").alias("spread_7")))


@query(HISTORY + "select cast(dayofweek(day) as int) as weekday, round(avg(recovery_score-target),6) as bias, round(avg(abs(recovery_score-target)),6) as mae, count(*) as n from pairs group by 1")
def error_by_weekday(spark, sf_dir):
    from ..functions import day_number

    p = monitor.persistence_forecast(nation_pairs(spark, sf_dir))
    return rounded(supervised.error_by(p, day_number(F.col("start_at")).alias("weekday")))


@query(DAILY + "select cast(start_at as date) as day, count(*) as cycles, round(avg(cycle_strain),6) as avg_strain from daily group by 1")
def daily_rollup(spark, sf_dir):
    from ..streaming import daily_rollup as rollup

    return rounded(rollup(silver(spark, sf_dir)["cycles"]).select(F.to_date("day").alias("day"), "cycles", "avg_strain"))


# ---------------------------------------------------------------- rows without SQL
@query()
def ridge_walk_forward(spark, sf_dir):
    """Out-of-sample forecasts of every nation's folds (ridge)."""
    return rounded(learn.validate_ridge(nation_folds(spark, sf_dir), _HF).select("user_id", "fold", "cycle_id", "target", "predicted", "residual"))


@query()
def ridge_incremental(spark, sf_dir):
    """Ridge weights after adding the pairs of odd cycles to a fit of the even."""
    pairs, keys = nation_pairs(spark, sf_dir), ["user_id"]
    first = learn.fit_ridge(pairs.where("cycle_id % 2 = 0"), keys, _HF)
    return learn.update_ridge(first, pairs.where("cycle_id % 2 = 1"), keys, _HF).select("user_id", "n", "weights", "intercept")


@query()
def isolation_flags(spark, sf_dir):
    """Isolation forest over all users' cycles."""
    return rounded(anomaly.isolation_forest(_daily(spark, sf_dir).select("cycle_id", "user_id", *anomaly.FLOORS)).select("cycle_id", "user_id", "isolation_score", "is_isolated"))


from . import ingest, landed, more  # noqa: E402, F401  they register their queries here
