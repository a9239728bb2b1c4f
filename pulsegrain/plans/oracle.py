"""DuckDB SQL: the derived tables, and the queries over them."""

from __future__ import annotations

SHAPES = """with base as (
  select event_id, user_id, ts, event_type, value, cast(json_extract_string(props,'$.k') as int) as k,
    user_id*1000 + date_diff('day', date '2024-01-01', cast(ts as date)) as cycle_id from events
),
cyc0 as (
  select cycle_id, user_id, min(ts) as start_at, max(ts) as updated_at, round(sum(value)/10.0,4) as raw from base group by cycle_id, user_id
),
cycles as (
  select cycle_id, user_id, start_at, updated_at,
    case when cycle_id%17=0 then null else least(start_at + interval '8' hour, lead(start_at) over (partition by user_id order by start_at)) end as end_at,
    case when cycle_id%10=9 then 'PENDING_SCORE' when cycle_id%10=8 then 'UNSCORABLE' else 'SCORED' end as score_state,
    case when cycle_id%10>=8 then null else least(cast(21.0 as double), raw) end as strain from cyc0
),
recovery as (
  select cycle_id, user_id, max(ts) as updated_at,
    case when cycle_id%10>=8 then null else max(k) end as recovery_score, case when cycle_id%10>=8 then null else 40+min(k) end as resting_heart_rate,
    case when cycle_id%10>=8 then null else round(20.0+max(value)/5.0,4) end as hrv_rmssd_milli
  from base where event_type='click' group by cycle_id, user_id
),
sleep as (
  select cast(event_id as varchar) as sleep_id, cycle_id, user_id, ts as updated_at, k%4=0 as is_nap, round(4+k/cast(20 as double),4) as total_in_bed_hours,
    round(value/100.0,4) as sleep_debt_need_hours, round(13+k/cast(25 as double),4) as respiratory_rate
  from base where event_type='view'
),
workouts as (
  select cast(event_id as varchar) as workout_id, user_id, ts as start_at, ts + interval '37' minute as end_at, case when k%7=0 then null else round(least(cast(21.0 as double), value/10.0),4) end as strain,
    round(value*11.0,4) as kilojoule, case k%5 when 0 then 'run' when 1 then 'ride' when 2 then 'lift' when 3 then 'swim' else 'row' end as sport_name, 90+k as average_heart_rate
  from base where event_type='purchase'
)
"""
#: The main sleep is the greatest by a key, a workout's cycle the greatest of
#: those that hold it, and its sums hang on the cycle by a grouped subquery.
DAILY = SHAPES + """, night as (
  select cycle_id, unnest(best) from (
    select cycle_id, arg_min({'sleep_id': sleep_id, 'total_in_bed_hours': total_in_bed_hours, 'sleep_debt_need_hours': sleep_debt_need_hours, 'respiratory_rate': respiratory_rate},
      {'age': -epoch_us(updated_at), 'name': sleep_id}) as best
    from sleep where is_nap = false group by cycle_id)
),
place as (
  select w.workout_id, w.user_id, arg_max(c.cycle_id, {'at': c.start_at, 'id': c.cycle_id}) as cycle_id
  from cycles c, workouts w where w.user_id = c.user_id and c.start_at <= w.start_at and coalesce(c.end_at > w.start_at, true) group by all
),
effort as (
  select c.cycle_id, c.user_id, coalesce(n, 0) as workout_count, coalesce(total, 0.0) as workout_total_strain, coalesce(top, 0.0) as workout_max_strain,
    coalesce(energy, 0.0) as workout_total_kilojoule, coalesce(length, 0.0) as workout_total_duration_hours
  from cycles c left join (
    select p.cycle_id, count(*) as n, round(sum(w.strain), 6) as total, round(max(w.strain), 6) as top, round(sum(w.kilojoule), 6) as energy, round(sum(epoch_ms(w.end_at) - epoch_ms(w.start_at)) / cast(3600000 as double), 6) as length
    from place p join workouts w using (workout_id) group by p.cycle_id) using (cycle_id)
),
daily as (
  select c.cycle_id, c.user_id, c.start_at, c.end_at, c.score_state as cycle_score_state, c.strain as cycle_strain, r.recovery_score, r.resting_heart_rate, r.hrv_rmssd_milli, n.sleep_id, n.total_in_bed_hours,
    n.sleep_debt_need_hours, n.respiratory_rate, e.* exclude (cycle_id, user_id)
  from effort e join cycles c using (cycle_id) left join night n using (cycle_id) left join recovery r using (cycle_id)
)
"""
#: Cycles are numbered by counting the earlier ones; the last seven, the one
#: before and the last low one are found by their numbers, without windows.
MART = DAILY + """, numbered as (
  select a.*, (select count(*) from daily b where b.user_id = a.user_id and (b.start_at < a.start_at or (b.start_at = a.start_at and b.cycle_id <= a.cycle_id))) as place from daily a
),
week as (
  select a.cycle_id, avg(b.recovery_score) as recovery, avg(b.cycle_strain) as strain, avg(b.hrv_rmssd_milli) as hrv, avg(b.sleep_debt_need_hours) as debt
  from numbered a join numbered b on b.user_id = a.user_id and a.place - b.place between 0 and 6 group by a.cycle_id
),
mart as (
  select a.cycle_id, a.user_id, a.start_at, (isodow(a.start_at) % 7)::int as day_of_week, a.cycle_strain, a.recovery_score, a.hrv_rmssd_milli, a.sleep_debt_need_hours,
    round(w.recovery, 6) as recovery_score_7d_avg, round(w.strain, 6) as cycle_strain_7d_avg, round(w.hrv, 6) as hrv_rmssd_milli_7d_avg, y.cycle_strain as prior_day_strain,
    round(w.debt, 6) as sleep_debt_7d_avg_hours, round(a.sleep_debt_need_hours - w.debt, 6) as sleep_debt_trend_hours,
    (a.place - (select max(l.place) from numbered l where l.user_id = a.user_id and l.place <= a.place and l.cycle_strain < 8))::bigint as days_since_last_low_strain_day
  from numbered a join week w using (cycle_id) left join numbered y on y.user_id = a.user_id and y.place = a.place - 1
)
"""
HISTORY = """with hist0 as (
  select cast(c_nationkey as bigint) as user_id, cast(o_orderdate as date) as day, cast(round(sum(o_totalprice),2) as double) as total, count(*) as n
  from orders join customer on o_custkey=c_custkey group by 1, 2
),
history as (
  select user_id, day, total, user_id*100000 + date_diff('day', date '1990-01-01', day) as cycle_id, cast(n*37%101 as double) as recovery_score,
    lag(cast(n*37%101 as double)) over (partition by user_id order by day) as prior from hist0
),
led as (select *, lead(recovery_score) over (partition by user_id order by day) as target, lead(cycle_id) over (partition by user_id order by day) as target_cycle_id,
  lead(day) over (partition by user_id order by day) as target_day from history),
pairs as (select *, case when target<=33 then 1 else 0 end as low_recovery, row_number() over (partition by user_id order by day) - 1 as row_index, count(*) over (partition by user_id) as n_rows
  from led where target is not null)
"""
#: Folds of 14 after 60, with a gap of one.
FOLDS = HISTORY + """, folds as (
  select p.*, f.fold, case when row_index < 60+f.fold*14 then 'train' when row_index < 61+f.fold*14 then 'purged' else 'test' end as role
  from pairs p cross join (select unnest(range(0,400)) as fold) f
  where n_rows >= 89 and f.fold < (n_rows - 61)//14 and row_index < 61 + f.fold*14 + 14
)
"""
TAIL = """, series as (
  select user_id, day, recovery_score - prior as residual, row_number() over (partition by user_id order by day) - 1 as i, count(*) over (partition by user_id) as n
  from history where prior is not null
),
tails as (
  select rep, user_id, n, list_aggregate(drawn, 'quantile_cont', 0.05) as lo, list_aggregate(drawn, 'quantile_cont', 0.95) as hi
  from (
    select rep, user_id, n, list_transform(range(0, n), lambda p: r[((rep*7919 + (p//7)*104729 + 31) % 1000003) % (n - 6) + p % 7 + 1]) as drawn
    from (select user_id, n, list(residual order by i) as r from series where n >= 20 group by 1, 2) u, (select unnest(range(0,1000)) as rep) x
  )
)
"""
FORECASTS = HISTORY + """, forecasts as (
  select user_id, cycle_id, day, least(100.0, greatest(0.0, coalesce(prior, recovery_score))) as predicted_value, target_cycle_id, target, target_day from led
),
settled as (
  select user_id, cycle_id, day, predicted_value, case when target_cycle_id is not null and cycle_id % 3 != 0 then target_cycle_id end as target_cycle_id,
    case when target_cycle_id is not null and cycle_id % 3 != 0 then target end as actual_value, case when target_cycle_id is not null and cycle_id % 3 != 0 then predicted_value - target end as error from forecasts
)
"""
