"""Queries of flattening, contracts, learners, forecasts and landed files.

SQL here states what the operators should give from the driver's tables, not
how they get there. Learners are checked with one feature, whose ridge weights
have a closed form.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..functions import one_hot_weekday
from ..operators import anomaly, contracts, explore, features, folds, learn, serving, supervised
from ..operators.flatten import flatten
from ..schemas import RECORDS, SILVER, ranges, required
from ..scratch import scratch_dir
from .inputs import nation_folds, nation_history, nation_pairs, silver
from .oracle import DAILY, FOLDS, FORECASTS, HISTORY, SHAPES
from .registry import ROBUST, WATCHED, _daily, _forecasts, _plain, query, rounded

# ---------------------------------------------------------------- flattening
_RAW = "with raw as (select event_id, user_id, date_trunc('second', ts) as ts, value, cast(json_extract_string(props,'$.k') as int) as k, event_id % 5 < 3 as scored, case event_id % 5 when 3 then 'PENDING_SCORE' when 4 then 'UNSCORABLE' else 'SCORED' end as state from events)"
_TS = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
_STATE = "case event_id % 5 when 3 then 'PENDING_SCORE' when 4 then 'UNSCORABLE' else 'SCORED' end"


def _leaf(table: str, name: str, path: str, kind: str) -> tuple[str, str]:
    """(text of the record's leaf in Spark SQL, value of the column in DuckDB)."""
    # a place in the table, so that columns differ
    i = [n for n, _, _ in SILVER[table]].index(name)
    if name == "user_id":
        return "cast(user_id as string)", "user_id"
    if name == "score_state":
        return _STATE, "state"
    if kind == "ts":
        return (f"case when event_id % 7 = 0 then 'not a time' else {_TS} end", "case when event_id % 7 = 0 then null else ts end") if name == "end_at" else (_TS, "ts")
    if kind == "string":
        return f"concat('{name[0]}', event_id)", f"concat('{name[0]}', event_id)"
    if kind == "bool":
        return "case when k % 2 = 0 then 'true' when k % 3 = 0 then 'false' else 'maybe' end", "case when k % 2 = 0 then true when k % 3 = 0 then false end"
    if kind == "long":
        return "concat(event_id, '.0')", "event_id"
    if kind == "int":
        return f"case when k % 11 = 0 then '3.5' when k % 13 = 0 then 'x' else cast(k + {i} as string) end", f"case when k % 11 = 0 or k % 13 = 0 then null else k + {i} end"
    if kind == "hours":
        return f"cast(k * 60000 + {i} as string)", f"round((k * 60000 + {i}) / 1000.0::double / 3600.0::double, 6)"
    return f"case when k % 17 = 0 then 'NaN' else cast(k + {i} + 0.25 as string) end", f"case when k % 17 = 0 then null else k + {i} + 0.25::double end"


def _struct(leaves: dict) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {_struct(v) if isinstance(v, dict) else v}" for n, v in leaves.items()) + ")"


def record_shape(table: str) -> tuple[str, list[str]]:
    """A table's record of an event: its struct in Spark SQL, and the flattened
    columns in DuckDB."""
    tree: dict = {}
    columns = []
    for name, path, kind in SILVER[table]:
        text, value = _leaf(table, name, path, kind)
        at = tree
        *outer, last = path.split(".")
        for part in outer:
            at = at.setdefault(part, {})
        at[last] = text
        columns.append(f"{f'case when scored then {value} end' if path.startswith('score.') else value} as {name}")
    return _struct(tree), columns


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with what the structs of record_shape read."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.withColumns({"ts": F.col("ts").cast("timestamp"), "k": F.get_json_object("props", "$.k").cast("int")})


def _flattened(table: str):
    struct, columns = record_shape(table)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = event_records(spark, sf_dir).select(F.to_json(F.expr(struct), {"ignoreNullFields": "false"}).alias("raw"))
        flat = rounded(flatten(raw.select(F.from_json("raw", RECORDS[table]).alias("r")).select("r.*"), table))
        return flat.select(*[F.col(n).cast("timestamp_ntz").alias(n) if kind == "ts" else F.col(n) for n, _, kind in SILVER[table]])

    run.__name__ = f"flatten_{table}"
    return query(f"{_RAW} select {', '.join(columns)} from raw")(run)


for _table in SILVER:
    _flattened(_table)


# ---------------------------------------------------------------- contracts
_HAVE = {
    "cycles": "cycle_id user_id start_at updated_at end_at score_state strain", "recovery": "cycle_id user_id updated_at score_state recovery_score resting_heart_rate hrv_rmssd_milli",
    "sleep": "sleep_id cycle_id user_id updated_at is_nap score_state total_in_bed_hours sleep_debt_need_hours respiratory_rate", "workouts": "workout_id user_id start_at end_at strain kilojoule sport_name average_heart_rate",
}
_BROKEN = SHAPES + """, b_cycles as (select * replace (case when cycle_id%11=0 then -strain-0.1 else strain end as strain, case when cycle_id%13=0 then 'LATE' else score_state end as score_state) from cycles),
b_recovery as (select *, case when cycle_id%10=9 then 'PENDING_SCORE' when cycle_id%10=8 then 'UNSCORABLE' else 'SCORED' end as score_state from (select * replace (case when cycle_id%7=0 then recovery_score+200 else recovery_score end as recovery_score) from recovery)),
b_sleep as (select *, case when cycle_id%10=9 then 'PENDING_SCORE' when cycle_id%10=8 then 'UNSCORABLE' else 'SCORED' end as score_state from (select * replace (case when cycle_id%5=0 then -respiratory_rate else respiratory_rate end as respiratory_rate) from sleep)),
b_workouts as (select * from workouts union all select * from workouts where cast(workout_id as bigint)%23=0)
"""


def _rules(table: str) -> list[str]:
    have = _HAVE[table].split()
    count = lambda c, rule, cond: f"select '{table}' as \"table\", '{c}' as \"column\", '{rule}' as rule, count(*) as violations from b_{table} where {cond}"
    out = [count(c, "not_null", f"{c} is null" if c in have else "true") for c in required(table)]
    for c, (low, high) in ranges(table).items():
        if c in have:
            out.append(count(c, "range", " or ".join([*([f"{c} < {low}"] if low is not None else []), *([f"{c} > {high}"] if high is not None else [])])))
    if "score_state" in have:
        out.append(count("score_state", "allowed", "score_state not in ('SCORED','PENDING_SCORE','UNSCORABLE')"))
    key = {"sleep": "sleep_id", "workouts": "workout_id"}.get(table, "cycle_id")
    return [*out, f"select '{table}', '{key}', 'unique', count(*) from (select {key} from b_{table} group by 1 having count(*)>1)"]


@query(_BROKEN + "select * from (" + " union all ".join(r for t in _HAVE for r in _rules(t)) + ") where violations > 0")
def full_contract(spark, sf_dir):
    """The report of all four tables, each with broken rows of its own."""
    t, i = silver(spark, sf_dir), F.col("cycle_id")
    t["cycles"] = t["cycles"].withColumns({"strain": F.when(i % 11 == 0, -F.col("strain") - 0.1).otherwise(F.col("strain")), "score_state": F.when(i % 13 == 0, "LATE").otherwise(F.col("score_state"))})
    t["recovery"] = t["recovery"].withColumn("recovery_score", F.when(i % 7 == 0, F.col("recovery_score") + 200).otherwise(F.col("recovery_score")))
    t["sleep"] = t["sleep"].withColumn("respiratory_rate", F.when(i % 5 == 0, -F.col("respiratory_rate")).otherwise(F.col("respiratory_rate")))
    t["workouts"] = t["workouts"].unionByName(t["workouts"].where(F.col("workout_id").cast("long") % 23 == 0))
    return contracts.contract_report(t).select("table", "column", "rule", "violations")


@query(HISTORY + """, seeded as (select user_id, cycle_id, day, case when cycle_id%89=0 then recovery_score+101 else recovery_score end as recovery_score, case when cycle_id%97=0 then 'infinity'::double else total end as total, prior from history),
gate as (select * from seeded union all select * from seeded where cycle_id%83=0)
select * from (select 'infinite:total' as rule, count(*) as violations from gate where isinf(total) union all select 'range:recovery_score', count(*) from gate where recovery_score>100
union all select 'duplicate:cycle_id', count(*) from (select 1 from gate group by user_id, cycle_id having count(*)>1) union all select 'duplicate:start_at', count(*) from (select 1 from gate group by user_id, day having count(*)>1)) where violations>0""")
def history_gate(spark, sf_dir):
    h, i = nation_history(spark, sf_dir), F.col("cycle_id")
    h = h.withColumns({"recovery_score": F.when(i % 89 == 0, F.col("recovery_score") + 101).otherwise(F.col("recovery_score")), "total": F.when(i % 97 == 0, F.lit(float("inf"))).otherwise(F.col("total"))})
    return supervised.history_violations(h.unionByName(h.where(i % 83 == 0)), ("recovery_score", "total", "prior"))


@query(SHAPES + "select sleep_id, cycle_id, respiratory_rate from sleep where respiratory_rate > 15.5")
def above_threshold(spark, sf_dir):
    return explore.above(silver(spark, sf_dir)["sleep"], "respiratory_rate", 15.5).select("sleep_id", "cycle_id", "respiratory_rate")


@query(DAILY + "select cycle_id, user_id, start_at, cycle_strain from daily order by start_at, cycle_id limit 10")
def first_rows(spark, sf_dir):
    return _plain(explore.preview(_daily(spark, sf_dir), ["start_at", "cycle_id"]).select("cycle_id", "user_id", "start_at", "cycle_strain"))


@query(DAILY + "select case when total_in_bed_hours<6 then '< 6 hrs' when total_in_bed_hours<7 then '6-7 hrs' when total_in_bed_hours<8 then '7-8 hrs' when total_in_bed_hours<9 then '8-9 hrs' else '9+ hrs' end as sleep_band, round(avg(recovery_score),6) as avg_recovery from daily where total_in_bed_hours is not null and recovery_score is not null group by 1 order by 2 desc, 1 limit 1")
def best_sleep_band(spark, sf_dir):
    return rounded(explore.best_sleep_band(_daily(spark, sf_dir)).select("sleep_band", "avg_recovery"))


@query(DAILY + ", p as (select 'week' as cycle, isodow(start_at)::int as position, recovery_score from daily union all select 'month', day(start_at)::int, recovery_score from daily) select cycle, position, round(avg(recovery_score),6) as avg_recovery, count(*) as n, round(avg(recovery_score) - (select avg(recovery_score) from daily),6) as from_mean from p where recovery_score is not null group by 1, 2")
def recovery_cycles(spark, sf_dir):
    return rounded(explore.recovery_cycles(_daily(spark, sf_dir)))


@query(DAILY + "select cycle_id, user_id, round(stddev_samp(cycle_strain) over (partition by user_id order by start_at, cycle_id rows between 6 preceding and current row), 6) as strain_spread from daily")
def strain_stability(spark, sf_dir):
    return rounded(features.strain_stability(_daily(spark, sf_dir)).select("cycle_id", "user_id", "strain_spread"))


@query(DAILY + "select * exclude (r) from (select cycle_id, user_id, cycle_strain, row_number() over (partition by user_id order by start_at desc, cycle_id desc) as r from daily) where r <= 5")
def recent_rows(spark, sf_dir):
    return features.recent_rows(_daily(spark, sf_dir), 5).select("cycle_id", "user_id", "cycle_strain")


@query(DAILY + "select cycle_id, " + ", ".join(f"(isodow(start_at)%7={i})::int as is_day_{i}" for i in range(7)) + " from daily")
def one_hot_weekdays(spark, sf_dir):
    return _daily(spark, sf_dir).select("cycle_id", *one_hot_weekday(F.col("start_at")))


@query("select column_name, column_type = 'DOUBLE' as is_double from (describe (select workout_id, strain, kilojoule from (" + SHAPES + "select * from workouts)))")
def described_columns(spark, sf_dir):
    d = explore.describe(silver(spark, sf_dir)["workouts"].select("workout_id", "strain", "kilojoule"))
    return d.select("column_name", (F.col("type") == "double").alias("is_double"))


# ---------------------------------------------------------------- landed files
@query("select user_id, count(*) as n, count(*) filter (event_type='click') as scored, round(sum(case when event_type='click' then value end), 4) as strain from events where event_id % 3 = 0 group by 1")
def bronze_round_trip(spark, sf_dir):
    """Records written as a pull's partition, read back and flattened; a repeated
    pull replaces its partition, and lines that are no records are told apart."""
    import datetime as dt

    root = f"{scratch_dir(spark)}/bronze-{uuid.uuid4().hex}"
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    score = F.struct(F.col("value").cast("string").alias("strain"))
    records = e.select(F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("user_id"), F.when(F.col("event_type") == "click", "SCORED").otherwise("PENDING_SCORE").alias("score_state"), score.alias("score"))
    day = dt.date(2024, 5, 1)
    sources.write_bronze(records, root, "cycles", day)
    sources.write_bronze(records.where(F.col("id").cast("long") % 3 == 0), root, "cycles", day)
    back = sources.read_bronze(spark, root, "cycles", day).where(f"{sources.CORRUPT} is null").drop(sources.CORRUPT, "pull_date")
    flat = flatten(back, "cycles")
    return flat.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("score_state") == "SCORED").alias("scored"), F.round(F.sum("strain"), 4).alias("strain"))


# ---------------------------------------------------------------- folds
@query(FOLDS + ", late as (select *, case when cycle_id%50=0 then target_day + 40 else target_day end as label_day from folds) select user_id, cast(fold as int) as fold from late group by 1, 2 having max(case when role='train' then label_day end) >= min(case when role='test' then day end)")
def leaking_folds(spark, sf_dir):
    """Folds that leak because some labels are dated 40 days late."""
    p = nation_pairs(spark, sf_dir)
    late = F.when(F.col("cycle_id") % 50 == 0, F.col("target_start_at") + F.expr("interval 40 days")).otherwise(F.col("target_start_at"))
    return folds.leaking_folds(folds.fold_rows(p.withColumn("target_start_at", late))).select("user_id", "fold")


@query(ROBUST + FOLDS.replace(HISTORY, "", 1) + "select f.user_id, cast(f.fold as int) as fold, round(avg(r.is_anomaly::int), 6) as flag_rate, count(*) as evaluated_rows from folds f join robust r using (user_id, cycle_id) where role='test' group by 1, 2")
def flag_rate(spark, sf_dir):
    """Share of every fold's test days that stand out from the 28 before them."""
    return rounded(_flag_rate(spark, sf_dir, anomaly.robust_scores(nation_history(spark, sf_dir), floors=WATCHED)))


def _flag_rate(spark, sf_dir, scored: DataFrame) -> DataFrame:
    tested = folds.test_rows(nation_folds(spark, sf_dir)).select("user_id", "cycle_id", "fold")
    return anomaly.flag_rate(tested.join(scored.select("user_id", "cycle_id", "is_anomaly"), ["user_id", "cycle_id"]))


@query()
def isolation_flag_rate(spark, sf_dir):
    """The same by the isolation forest over all nations' days."""
    scored = anomaly.isolation_forest(nation_history(spark, sf_dir), list(WATCHED))
    return rounded(_flag_rate(spark, sf_dir, scored.withColumnRenamed("is_isolated", "is_anomaly")))


@query(FOLDS + ", s as (select user_id, fold, count(distinct low_recovery) < 2 as skipped from folds where role='train' group by 1, 2) select user_id, count(*) as folds, count(*) filter (skipped) as skipped_folds from s group by 1")
def classifier_folds(spark, sf_dir):
    """Folds of each user, and those that are skipped and counted because their
    training rows hold one class."""
    status = folds.fold_status(nation_folds(spark, sf_dir))
    return status.groupBy("user_id").agg(F.count("*").alias("folds"), F.count_if("skipped").alias("skipped_folds"))


@query()
def low_recovery_walk_forward(spark, sf_dir):
    """Out-of-sample probabilities of low recovery of every nation's folds."""
    out = learn.validate_low_recovery(nation_folds(spark, sf_dir), ("recovery_score", "total", "prior"))
    return rounded(out.select("user_id", "fold", "cycle_id", "low_recovery", "probability"))


@query()
def boosted_walk_forward(spark, sf_dir):
    """Out-of-sample forecasts of every nation's folds by boosted trees."""
    return rounded(learn.validate_boosted(nation_folds(spark, sf_dir), ("recovery_score", "total", "prior")).select("user_id", "fold", "cycle_id", "target", "predicted"))


# ---------------------------------------------------------------- ridge with one feature
# z = (x - mean) / deviation of the training rows; weight = sum z (y - mean y) / (n + 10)
_ONE = ("recovery_score",)
_FIT = "avg(recovery_score) as m, coalesce(nullif(stddev_pop(recovery_score), 0), 1) as s, avg(target) as b, count(*) as n, covar_pop(recovery_score, target) as c"
_WEIGHT = "(c * n / s) / (n + 10)"
_CLIP = "least(100.0, greatest(0.0, {}))"


@query(HISTORY + f", f as (select user_id, {_FIT} from pairs group by 1) select user_id, n, round({_WEIGHT}, 6) as weight, round(b, 6) as intercept from f")
def ridge_weights(spark, sf_dir):
    m = learn.fit_ridge(nation_pairs(spark, sf_dir), ["user_id"], _ONE)
    return rounded(m.select("user_id", "n", F.col("weights")[0].alias("weight"), "intercept"))


@query(HISTORY + f""", f as (select user_id, avg(recovery_score) as m, coalesce(nullif(stddev_pop(recovery_score), 0), 1) as s from pairs where cycle_id%2=0 group by 1),
z as (select user_id, target as y, (recovery_score - m)/s as z from pairs join f using (user_id)), g as (select user_id, count(*) as n, avg(y) as y, avg(z) as z, covar_pop(z, y)*count(*) as zy, var_pop(z)*count(*) as zz from z group by 1)
select user_id, n, round(zy/(zz+10), 6) as weight, round(y - zy/(zz+10)*z, 6) as intercept from g""")
def ridge_updated(spark, sf_dir):
    """A fit of the even cycles, with the odd ones added to its sums."""
    p, keys = nation_pairs(spark, sf_dir), ["user_id"]
    m = learn.update_ridge(learn.fit_ridge(p.where("cycle_id % 2 = 0"), keys, _ONE), p.where("cycle_id % 2 = 1"), keys, _ONE)
    return rounded(m.select("user_id", "n", F.col("weights")[0].alias("weight"), "intercept"))


@query(HISTORY + f", f as (select user_id, {_FIT} from pairs group by 1) select p.user_id, cycle_id, 'recovery_score' as feature, round({_WEIGHT} * (recovery_score - m)/s, 6) as contribution from pairs p join f using (user_id)")
def contributions(spark, sf_dir):
    p = nation_pairs(spark, sf_dir)
    return rounded(learn.contributions(p, learn.fit_ridge(p, ["user_id"], _ONE), ["user_id"], _ONE))


_OUT = FOLDS + f", f as (select user_id, fold, {_FIT} from folds where role='train' group by 1, 2), ridge as (select t.user_id, t.fold, cycle_id, target, " + _CLIP.format(f"b + {_WEIGHT} * (recovery_score - m)/s") + " as predicted from folds t join f on f.user_id=t.user_id and f.fold=t.fold where role='test')"
#: The state of a fold has all its training rows, scaled as the first fold's are.
_STEP = _OUT + """, first as (select user_id, m, s from f where fold=0), z as (select t.user_id, fold, target as y, (recovery_score - m)/s as z from folds t join first using (user_id) where role='train'),
g as (select user_id, fold, count(*) as n, avg(y) as y, avg(z) as z, covar_pop(z, y)*count(*)/(var_pop(z)*count(*)+10) as w from z group by 1, 2),
step as (select t.user_id, t.fold, cycle_id, target, """ + _CLIP.format("y + w * ((recovery_score - m)/s - z)") + " as predicted from folds t join g on g.user_id=t.user_id and g.fold=t.fold join first on first.user_id=t.user_id where role='test')"


@query(_OUT + "select user_id, cast(fold as int) as fold, cycle_id, round(predicted, 6) as predicted, round(target - predicted, 6) as residual from ridge")
def ridge_folds(spark, sf_dir):
    out = learn.validate_ridge(nation_folds(spark, sf_dir), _ONE)
    return rounded(out.select("user_id", "fold", "cycle_id", "predicted", "residual"))


@query(_STEP + "select user_id, cast(fold as int) as fold, cycle_id, round(predicted, 6) as predicted from step")
def incremental_folds(spark, sf_dir):
    out = learn.validate_incremental(nation_folds(spark, sf_dir), _ONE)
    return rounded(out.select("user_id", "fold", "cycle_id", "predicted"))


@query(_STEP + """, every as (select user_id, fold, 'ridge' as model_name, target, predicted from ridge union all select user_id, fold, 'incremental_ridge', target, predicted from step union all select user_id, fold, 'persistence', target, recovery_score from folds where role='test'),
one as (select user_id, fold, model_name, avg(abs(predicted - target)) as mae from every group by 1, 2, 3) select user_id, model_name, round(avg(mae), 6) as mean, round(stddev_pop(mae), 6) as std, count(*) as folds from one group by 1, 2""")
def model_suite(spark, sf_dir):
    """Fold errors of all forecasters over the same folds, side by side."""
    out = learn.compare_models(nation_folds(spark, sf_dir), _ONE, ("persistence", "ridge", "incremental_ridge"))
    return rounded(out.where("metric = 'mae'").select("user_id", "model_name", "mean", "std", "folds"))


# ---------------------------------------------------------------- forecasts
@query(FORECASTS + "select user_id, cycle_id, predicted_value from forecasts where cycle_id % 4 != 0")
def forecast_records(spark, sf_dir):
    p, _ = _forecasts(spark, sf_dir)
    p = p.withColumn("model_name", F.when(F.col("cycle_id") % 4 == 0, "other").otherwise(F.col("model_name")))
    return serving.prediction_records(p, "persistence").select("user_id", "cycle_id", "predicted_value")


@query(FORECASTS + "select user_id, cycle_id from forecasts where cycle_id % 6 = 0 or cycle_id % 5 = 0 and predicted_value > 0 or cycle_id % 7 = 0")
def forecast_violations(spark, sf_dir):
    """Values out of range, intervals that do not hold their forecast, and nulls."""
    p, _ = _forecasts(spark, sf_dir)
    i = F.col("cycle_id")
    p = p.withColumns({"ci_lower": F.when(i % 6 == 0, -1.0).otherwise(F.col("ci_lower")), "ci_upper": F.when(i % 5 == 0, 0.0).otherwise(F.col("ci_upper")), "created_at": F.when(i % 7 == 0, None).otherwise(F.col("created_at"))})
    return serving.prediction_violations(p).select("user_id", "cycle_id")
