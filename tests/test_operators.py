"""Known answers, with records of our own."""

from __future__ import annotations

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrain import sources
from pulsegrain.functions import one_hot_weekday
from pulsegrain.operators import anomaly, contracts, daily, explore, features, folds, intervals, learn, monitor, serving, supervised, tables
from pulsegrain.operators.flatten import conform, flatten
from pulsegrain.schemas import RECORD_TYPES, RECORDS, SILVER, silver_type

UTC = dt.timezone.utc


def at(day: int, hour: float = 0) -> dt.datetime:
    return dt.datetime(2024, 3, 1) + dt.timedelta(days=day, hours=hour)


def iso(day: int, hour: float = 0) -> str:
    return at(day, hour).strftime("%Y-%m-%dT%H:%M:%S.000Z")


def records(user: int = 7) -> dict[str, list[dict]]:
    common = {"user_id": user, "created_at": iso(0), "updated_at": iso(1), "timezone_offset": "+02:00"}
    return {
        "cycles": [
            common | {"id": 1, "start": iso(0), "end": iso(1), "score_state": "SCORED", "score": {"strain": 12.5, "kilojoule": "8000.5", "average_heart_rate": 61, "max_heart_rate": 150}},
            common | {"id": 2, "start": iso(1), "score_state": "PENDING_SCORE"},
            common | {"id": 3, "start": iso(2), "end": iso(3), "score_state": "UNSCORABLE", "score": {"strain": 9.0}},
        ],
        "recovery": [common | {"cycle_id": 1, "sleep_id": "s1", "score_state": "SCORED", "score": {"user_calibrating": False, "recovery_score": 66, "resting_heart_rate": 50, "hrv_rmssd_milli": 70.25}}],
        "sleep": [
            common | {"id": "s1", "cycle_id": 1, "start": iso(0), "end": iso(0, 8), "nap": False, "score_state": "SCORED", "score": {"stage_summary": {"total_in_bed_time_milli": 27_000_000}, "sleep_needed": {"need_from_recent_nap_milli": -3_600_000}, "respiratory_rate": 15.5}},
            common | {"id": "s2", "cycle_id": 1, "start": iso(0, 13), "end": iso(0, 14), "nap": True, "score_state": "SCORED", "updated_at": iso(5), "score": {"stage_summary": {"total_in_bed_time_milli": 3_600_000}}},
        ],
        "workouts": [
            common | {"id": "w1", "start": iso(0, 10), "end": iso(0, 11), "sport_name": "run", "score_state": "SCORED", "score": {"strain": 8.0, "kilojoule": 900, "zone_durations": {"zone_two_milli": 1_800_000}}},
        ],
    }


def land(tmp_path, rows: list[dict], name: str) -> str:
    path = tmp_path / name
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


@pytest.fixture(scope="module")
def frames(spark):
    out = {}
    for t in RECORD_TYPES:
        rows = spark.createDataFrame([(json.dumps(r),) for r in records()[t]], "raw string")
        out[t] = flatten(rows.select(F.from_json("raw", RECORDS[t]).alias("r")).select("r.*"), t)
    return out


# ------------------------------------------------------------------ flatten
def test_scores_are_gated_and_typed(frames):
    rows = {r["cycle_id"]: r for r in frames["cycles"].collect()}
    assert rows[1]["kilojoule"] == 8000.5 and rows[1]["average_heart_rate"] == 61
    assert rows[2]["strain"] is None and rows[2]["end_at"] is None
    assert rows[3]["strain"] is None  # a score is there, but not SCORED
    sleep = {r["sleep_id"]: r for r in frames["sleep"].collect()}
    assert sleep["s1"]["total_in_bed_hours"] == 7.5 and sleep["s1"]["recent_nap_need_hours"] == -1.0
    assert frames["workouts"].first()["zone_2_hours"] == 0.5
    for t in RECORD_TYPES:
        assert frames[t].columns == [c for c, _, _ in SILVER[t]]
        assert [f.dataType for f in frames[t].schema] == [f.dataType for f in silver_type(t)]


def test_bad_scalars_become_null(spark):
    raw = json.dumps({"id": "x", "user_id": "7", "start": "never", "score_state": "SCORED", "score": {"strain": "NaN", "average_heart_rate": 60.5}})
    row = flatten(spark.createDataFrame([(raw,)], "raw string").select(F.from_json("raw", RECORDS["cycles"]).alias("r")).select("r.*"), "cycles").first()
    assert row["cycle_id"] is None and row["start_at"] is None and row["strain"] is None and row["average_heart_rate"] is None and row["user_id"] == 7


def test_empty_input_stays_typed(spark):
    out = flatten(spark.createDataFrame([], RECORDS["sleep"]), "sleep")
    assert out.count() == 0 and len(out.columns) == 26


# ------------------------------------------------------------------ sources
def test_bronze_partition_is_replaced(spark, tmp_path):
    root, day = str(tmp_path / "bronze"), dt.date(2024, 3, 1)
    path = land(tmp_path, records()["cycles"], "in")
    cycles = spark.read.schema(RECORDS["cycles"]).json(path)
    sources.write_bronze(cycles, root, "cycles", day)
    sources.write_bronze(cycles, root, "cycles", dt.date(2024, 3, 2))
    back = sources.read_bronze(spark, root, "cycles")
    assert back.count() == 6 and back.where("_corrupt_record is not null").count() == 0
    sources.write_bronze(cycles.limit(0), root, "cycles", day)
    assert sources.read_bronze(spark, root, "cycles").count() == 3
    assert sources.read_bronze(spark, root, "cycles", since=dt.date(2024, 3, 3)).count() == 0
    with pytest.raises(ValueError):
        sources.write_bronze(cycles, root, "steps", day)
    with pytest.raises(ValueError):
        sources.write_bronze_pull({"cycles": cycles}, root, day)


def test_pages_arrays_and_exports(spark, tmp_path):
    page = tmp_path / "page.json"
    page.write_text(json.dumps({"records": [*records()["cycles"], 5, "x"], "next_token": None}))
    good, bad = sources.read_pages(spark, str(page), "cycles")
    assert good.count() == 3 and bad.count() == 2
    array = tmp_path / "array.json"
    array.write_text(json.dumps(records()["sleep"]))
    assert sources.read_array_file(spark, str(array), "sleep").count() == 2
    export = tmp_path / "export.json"
    export.write_text(json.dumps({"user": {"id": 1}, **records()}))
    assert {t: df.count() for t, df in sources.read_export(spark, str(export)).items()} == {"cycles": 3, "recovery": 1, "sleep": 2, "workouts": 1}


def test_sync_window_and_order(spark, tmp_path):
    today = dt.date(2024, 3, 10)
    assert sources.sync_start(today, None) == dt.date(2023, 9, 12)
    assert sources.sync_start(today, dt.date(2024, 3, 8)) == dt.date(2024, 3, 8)
    with pytest.raises(ValueError):
        sources.sync_start(today, None, -1)
    landing = {}
    for t in RECORD_TYPES:
        (tmp_path / f"{t}.json").write_text(json.dumps({"records": records()[t]}))
        landing[t] = str(tmp_path / f"{t}.json")
    seen = []
    counts = sources.sync_landing(spark, landing, str(tmp_path / "b"), dt.datetime(2024, 3, 10, tzinfo=UTC), None, seen.append)
    assert counts == {"cycles": 3, "recovery": 1, "sleep": 2, "workouts": 1} and seen == [today]
    with pytest.raises(ValueError):
        sources.sync_landing(spark, landing, str(tmp_path / "b"), dt.datetime(2024, 3, 10), None, seen.append)
    sources.export_csv(spark.range(3), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3


@pytest.mark.parametrize("lines", [False, True])
def test_pages_that_are_cut_off_are_rejects(spark, tmp_path, lines):
    whole = json.dumps({"records": [*records()["cycles"], 5, None, "x"], "next_token": None})
    texts = [whole, '{"records": [', '{"records": 7}', '{"next_token": "a"}']
    if lines:
        (tmp_path / "in.jsonl").write_text("\n\n".join(texts) + "\n")
    else:
        for i, t in enumerate(texts):
            (tmp_path / f"{i}.json").write_text(t)
    good, bad = sources.read_pages(spark, str(tmp_path), "cycles", lines=lines)
    assert good.count() == 3
    assert sorted(str(r["raw"]) for r in bad.collect()) == sorted(["5", "None", "x", '{"records": [', '{"records": 7}'])


def test_exports_by_line(spark, tmp_path):
    one, none = json.dumps(records()), json.dumps({"user": {"id": 2}, "cycles": []})
    (tmp_path / "in.jsonl").write_text(f"{one}\n{none}\n{one}\n")
    assert {t: df.count() for t, df in sources.read_export(spark, str(tmp_path), lines=True).items()} == {"cycles": 6, "recovery": 2, "sleep": 4, "workouts": 2}


def test_sync_keeps_rejects_and_what_tells_no_time(spark, tmp_path):
    landing = {}
    for t in RECORD_TYPES:
        untimed = [{**r, "updated_at": None} for r in records()[t]]
        (tmp_path / f"{t}.json").write_text(json.dumps({"records": [*records()[t], *untimed, 9]}))
        landing[t] = str(tmp_path / f"{t}.json")
    now = dt.datetime(2030, 1, 2, tzinfo=UTC)
    counts = sources.sync_landing(spark, landing, str(tmp_path / "b"), now, dt.date(2030, 1, 1), lambda d: None)
    assert counts == {"cycles": 3, "recovery": 1, "sleep": 2, "workouts": 1}  # those without a time
    for _ in range(2):  # a repeated pull replaces its rejects
        sources.sync_landing(spark, landing, str(tmp_path / "b"), now, dt.date(2030, 1, 1), lambda d: None)
    assert [r["value"] for r in spark.read.text(str(tmp_path / "b/rejects/sleep")).collect()] == ["9"]


def test_csv_comes_back_as_it_was(spark, tmp_path):
    rows = [(1, 'a "b", c\\', dt.datetime(2024, 1, 2, 3, 4, 5, 678901), 0.1 + 0.2), (2, "two\nlines", None, None), (3, "", None, -0.0), (4, None, None, 1e300)]
    df = spark.createDataFrame(rows, "id int, text string, at timestamp, x double")
    sources.export_csv(df, str(tmp_path / "csv"))
    assert sources.read_csv(spark, str(tmp_path / "csv"), df.schema).orderBy("id").collect() == df.orderBy("id").collect()


# ------------------------------------------------------------------ contracts
def test_contract_accepts_and_rejects(frames):
    contracts.enforce(frames)
    bad = dict(frames)
    bad["cycles"] = frames["cycles"].withColumn("strain", F.lit(-0.1)).unionByName(frames["cycles"])
    bad["recovery"] = frames["recovery"].withColumn("recovery_score", F.lit(101))
    bad["sleep"] = frames["sleep"].withColumn("sleep_efficiency_percentage", F.lit(101.0))
    got = {(r["table"], r["column"], r["rule"]) for r in contracts.contract_report(bad).collect()}
    assert got == {("cycles", "strain", "range"), ("cycles", "cycle_id", "unique"), ("recovery", "recovery_score", "range"), ("sleep", "sleep_efficiency_percentage", "range")}
    with pytest.raises(contracts.ContractError):
        contracts.enforce(bad)
    missing = {k: v for k, v in frames.items() if k != "sleep"}
    missing["cycles"] = frames["cycles"].drop("strain").withColumn("more", F.lit(1))
    got = {(r["table"], r["column"], r["rule"]) for r in contracts.contract_report(missing).collect()}
    assert got == {("sleep", "", "missing_table"), ("cycles", "strain", "missing_column"), ("cycles", "more", "extra_column")}


# ------------------------------------------------------------------ tables
def test_store_commits_all_or_nothing(spark, frames, tmp_path):
    store = tables.Store(spark, f"file://{tmp_path}/gold")
    assert store.last_synced_date() is None
    store.load_gold(frames, dt.date(2024, 3, 1))
    store.load_gold(frames, dt.date(2024, 3, 2))
    assert store.read("cycles").count() == 3 and store.last_synced_date() == dt.date(2024, 3, 2)
    changed = dict(frames)
    changed["cycles"] = frames["cycles"].where("cycle_id = 1").withColumn("strain", F.lit(1.5))
    store.load_gold(changed, dt.date(2024, 3, 3))
    assert {r["cycle_id"]: r["strain"] for r in store.read("cycles").collect()} == {1: 1.5, 2: None, 3: None}
    before = store.manifest()
    broken = dict(frames)
    broken["sleep"] = frames["sleep"].withColumn("total_in_bed_hours", F.lit(-1.0))
    with pytest.raises(contracts.ContractError):
        store.load_gold(broken, dt.date(2024, 3, 9))
    boom = F.udf(lambda x: 1 // 0, "double")
    with pytest.raises(Exception):
        store.commit({"cycles": frames["cycles"], "sleep": frames["sleep"].withColumn("respiratory_rate", boom("sleep_id"))}, dt.date(2024, 3, 9))
    assert store.manifest() == before
    store.load_gold({n: df.limit(0) for n, df in frames.items()}, dt.date(2024, 3, 4))
    assert store.read("cycles").count() == 3 and store.last_synced_date() == dt.date(2024, 3, 4)
    newest = sorted((tmp_path / "gold").glob("manifest-*.json"))[-1]
    newest.write_text("{")
    (tmp_path / "gold" / f".{newest.name}.crc").unlink(missing_ok=True)
    with pytest.raises(tables.ManifestError):
        store.manifest()


def test_two_writers(spark, tmp_path):
    """Neither loses what the other wrote: other tables are taken up, the same
    one is merged again; a merge rewrites its own buckets only."""
    root = f"file://{tmp_path}/gold"
    one, two = tables.Store(spark, root, buckets=4), tables.Store(spark, root, buckets=4)
    rows = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    one.merge({"t": (rows(0, 100, 1), "k")})
    before = one.manifest()["tables"]["t"]["parts"]
    real, between = tables.Store._publish, []

    def late(self, manifest):
        if self is one and not between:
            between.append(two.merge({"t": (rows(50, 51, 2), "k")}))
            two.commit({"u": rows(0, 3, 9)})
        return real(self, manifest)

    try:
        tables.Store._publish = late
        one.merge({"t": (rows(10, 11, 3), "k")})
    finally:
        tables.Store._publish = real
    got = {r["k"]: r["v"] for r in one.read("t").collect()}
    assert len(got) == 100 and got[50] == 2 and got[10] == 3 and got[0] == 1 and one.read("u").count() == 3
    after = one.manifest()["tables"]["t"]["parts"]
    assert set(after) == set(before) and 0 < sum(after[k] != before[k] for k in before) <= 2
    assert one.vacuum(1) > 0 and {r["k"]: r["v"] for r in one.read("t").collect()} == got and len(one._versions()) == 1
    one.merge({"t": (rows(0, 0, 1), "k"), "empty": (rows(0, 0, 1), "k")})
    assert one.read("t").count() == 100 and one.read("empty").count() == 0


# ------------------------------------------------------------------ daily
def test_interval_assignment(spark):
    cycles = spark.createDataFrame(
        [(1, 10, at(0), at(1)), (1, 11, at(2), None), (1, 12, at(3), at(3, 2)), (1, 13, at(4), None), (2, 20, at(0), None), (1, 14, at(9), at(9))], "user_id long, cycle_id long, start_at timestamp, end_at timestamp"
    )
    ws = [("start", 1, at(0)), ("end", 1, at(1)), ("gap", 1, at(1, 5)), ("before", 1, at(-1)), ("open", 1, at(2, 1)), ("closed", 1, at(3, 1)), ("older_open", 1, at(3, 5)), ("latest_open", 1, at(5)), ("other", 2, at(5)), ("nobody", 3, at(5))]
    w = spark.createDataFrame([(n, u, t, t + dt.timedelta(minutes=30)) for n, u, t in ws], "workout_id string, user_id long, start_at timestamp, end_at timestamp").withColumns({"strain": F.lit(2.0), "kilojoule": F.lit(5.0)})
    got = {r["workout_id"]: r["cycle_id"] for r in daily.assign_workouts(w, cycles).collect()}
    assert got == {"start": 10, "open": 11, "closed": 12, "older_open": 11, "latest_open": 13, "other": 20}
    by = {r["cycle_id"]: r for r in daily.workouts_by_cycle(cycles, daily.assign_workouts(w, cycles)).collect()}
    assert by[11]["workout_count"] == 2 and by[11]["workout_total_duration_hours"] == 1.0 and by[14]["workout_count"] == 0 and by[14]["workout_max_strain"] == 0.0


def test_daily_summary_takes_the_main_sleep(frames):
    out = daily.daily_summary(frames["cycles"], frames["recovery"], frames["sleep"], frames["workouts"])
    assert len(out.columns) == 40
    rows = {r["cycle_id"]: r for r in out.collect()}
    assert rows[1]["sleep_id"] == "s1" and rows[1]["workout_count"] == 1 and rows[1]["recovery_score"] == 66
    assert rows[2]["sleep_id"] is None and rows[2]["workout_total_strain"] == 0.0
    assert len(features.mart_daily_features(out).columns) == 15
    with pytest.raises(ValueError):
        daily.one_to_one(frames["cycles"], frames["sleep"], ["cycle_id"])


def history(spark, scores, user=1, day0=0):
    rows = [(user, user * 1000 + i, at(day0 + i), None if s is None else float(s)) for i, s in enumerate(scores)]
    df = spark.createDataFrame(rows, "user_id long, cycle_id long, start_at timestamp, recovery_score double")
    return df.withColumns({f: F.col("recovery_score") if f == "recovery_score" else F.pmod(F.xxhash64("cycle_id", F.lit(f)), F.lit(100)).cast("double") for f in features.FEATURES})


# ------------------------------------------------------------------ models
def test_pairs_never_skip_a_pending_cycle(spark):
    out = supervised.supervised_pairs(history(spark, [10, 85, None, 33, 34, 90])).orderBy("start_at").collect()
    assert [r["target"] for r in out] == [85, 33, 34, 90] and [r["low_recovery"] for r in out] == [0, 1, 0, 0]


def test_future_changes_leave_the_past(spark):
    a, b = history(spark, range(40)), history(spark, [*range(30), *[99] * 10])
    past = lambda h: [tuple(r) for r in features.mart_daily_features(h).where(F.col("start_at") < at(30)).orderBy("start_at").collect()]
    assert past(a) == past(b)


def test_history_gate(spark):
    h = history(spark, [50, 60])
    assert supervised.history_violations(h).count() == 0
    bad = h.unionByName(h).withColumn("recovery_score", F.lit(101.0)).withColumn("cycle_strain", F.lit(float("inf")))
    assert {r["rule"] for r in supervised.history_violations(bad).collect()} == {"range:recovery_score", "infinite:cycle_strain", "duplicate:cycle_id", "duplicate:start_at"}
    assert supervised.history_violations(h.drop("cycle_strain")).first()["rule"] == "missing_column:cycle_strain"


def test_readiness(spark):
    assert supervised.readiness(supervised.supervised_pairs(history(spark, [50] * 92))).first()["ready"]
    assert not supervised.readiness(supervised.supervised_pairs(history(spark, [50] * 90))).first()["ready"]


def test_metrics(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (1, 10.0, 12.0), (1, 20.0, 18.0), (2, 4.0, 4.0), (2, 4.0, 4.0), (3, 4.0, 5.0), (3, 4.0, 4.0)], "k int, target double, predicted double")
    rows = {r["k"]: r for r in supervised.regression_metrics(df, ["k"]).collect()}
    assert rows[1]["mape"] == pytest.approx(15) and rows[1]["mape_excluded_zeros"] == 1 and rows[1]["mae"] == pytest.approx(3) and rows[1]["r2"] == pytest.approx(1 - 33 / 200)
    assert rows[2]["r2"] == 1.0 and rows[3]["r2"] == 0.0
    c = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (1, 1, 0.4), (1, 0, 0.1), (2, 0, 0.2), (2, 0, 0.9)], "k int, low_recovery int, probability double")
    rows = {r["k"]: r for r in supervised.classification_metrics(c, ["k"]).collect()}
    assert rows[1]["precision"] == 1.0 and rows[1]["recall"] == 0.5 and rows[1]["auc"] == pytest.approx(3.5 / 4)
    assert rows[2]["auc"] is None and rows[2]["recall"] == 0.0
    long = supervised.metrics_long(supervised.classification_metrics(c, ["k"]), ["k"])
    assert {(r["metric"], r["folds"]) for r in supervised.metric_summary(long, []).collect()} == {("precision", 2), ("recall", 2), ("positive_count", 2), ("auc", 1)}


def test_robust_scores_match_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [(1, i, at(i), *(None if rng.random() < 0.2 else float(v) for v in rng.normal(50, 5, 4))) for i in range(60)]
    rows[50] = (1, 50, at(50), 500.0, 50.0, 50.0, 50.0)
    df = spark.createDataFrame(rows, "user_id long, cycle_id long, start_at timestamp, " + ", ".join(f"{c} double" for c in anomaly.FLOORS))
    got = anomaly.robust_scores(df).orderBy("cycle_id").collect()
    for j, (c, floor) in enumerate(anomaly.FLOORS.items()):
        x = np.array([np.nan if r[3 + j] is None else r[3 + j] for r in rows])
        for i in range(60):
            base = x[max(0, i - 28) : i]
            base = base[~np.isnan(base)]
            if len(base) < 14 or np.isnan(x[i]):
                assert got[i][f"z_{c}"] is None
            else:
                m = np.median(base)
                assert got[i][f"z_{c}"] == pytest.approx(abs(x[i] - m) / max(1.4826 * np.median(abs(base - m)), floor))
    assert got[50]["is_anomaly"]
    tail = anomaly.score_new(df.where("cycle_id < 40"), df.where("cycle_id >= 40")).orderBy("cycle_id").collect()
    assert [r["is_anomaly"] for r in tail] == [r["is_anomaly"] for r in got[40:]]
    iso = anomaly.isolation_forest(df, trees=25).orderBy(F.desc("isolation_score")).collect()
    assert iso[0]["cycle_id"] == 50 and iso[0]["is_isolated"]


def _pairs(spark, n=120, users=(1, 2)):
    out = None
    for u in users:
        rng = np.random.default_rng(u)
        h = supervised.supervised_pairs(history(spark, [float(x) for x in rng.integers(0, 100, n)], user=u))
        out = h if out is None else out.unionByName(h)
    return out.withColumn("cycle_strain", F.when(F.col("cycle_id") % 7 == 0, None).otherwise(F.col("cycle_strain"))).withColumn("prior_day_strain", F.lit(None).cast("double"))


def test_ridge_matches_numpy(spark):
    pairs = _pairs(spark)
    models = {r["user_id"]: r for r in learn.fit_ridge(pairs, ["user_id"]).collect()}
    for u, rows in pairs.orderBy("start_at").toPandas().groupby("user_id"):
        x = rows[list(features.FEATURES)].astype(float)
        x = x.fillna(x.median()).fillna(0).to_numpy()
        sd = x.std(0)
        z = (x - x.mean(0)) / np.where(sd > 0, sd, 1)
        y = rows["target"].to_numpy()
        w = np.linalg.solve(z.T @ z + 10 * np.eye(z.shape[1]), z.T @ (y - y.mean()))
        assert models[u]["weights"] == pytest.approx(w, abs=1e-8) and models[u]["intercept"] == pytest.approx(y.mean())
    half = learn.fit_ridge(pairs.where("cycle_id % 2 = 0"), ["user_id"])
    both = learn.update_ridge(half, pairs.where("cycle_id % 2 = 1"), ["user_id"])
    assert {r["user_id"]: r["n"] for r in both.collect()} == {r: m["n"] for r, m in models.items()}
    p = learn.predict_ridge(pairs, both, ["user_id"])
    assert p.where("predicted < 0 or predicted > 100 or predicted is null").count() == 0
    assert learn.contributions(pairs.limit(3), both, ["user_id"]).count() == 3 * len(features.FEATURES)


def test_pooled_models(spark):
    pairs = _pairs(spark, users=(1,))
    out = learn.predict_boosted(pairs, learn.fit_boosted(pairs, trees=5))
    assert out.where("predicted between 0 and 100").count() == pairs.count()
    prob = learn.predict_low_recovery(pairs, learn.fit_low_recovery(pairs))
    assert prob.where("probability between 0 and 1").count() == pairs.count()


@pytest.mark.parametrize(
    ("errors", "days", "reason"),
    [
        ([16], 0, "emergency"), ([15], 0, "stable"), ([-16], 0, "emergency"), ([6] * 7, 0, "bias_correction"), ([5] * 7, 0, "stable"), ([6] * 6, 0, "stable"),
        ([1, -1] * 3 + [1] + [4, -4] * 3 + [4], 0, "drift_correction"), ([1, -1] * 3 + [1] + [2, -2] * 3 + [2], 0, "stable"), ([], 7, "routine"), ([], 6, "stable"), ([0], -1, "invalid"), ([float("nan")], 0, "invalid"),
    ],
)
def test_retrain_decision(spark, errors, days, reason):
    e = spark.createDataFrame([(1, float(x), i) for i, x in enumerate(errors)], "user_id long, error double, i int")
    one = spark.createDataFrame([(1, days)], "user_id long, days_since_update int")
    got = monitor.retrain_decision(one.join(monitor.error_windows(e, ["i"]), "user_id", "left")).first()
    assert got["reason"] == reason and got["should_update"] == (reason not in ("stable", "invalid"))


def test_bootstrap_matches_numpy(spark):
    r = np.random.default_rng(3).normal(0, 10, 45)
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(r)] + [(2, i, 1.0) for i in range(19)], "user_id long, i int, residual double")
    start = lambda rep, b, places: (rep.cast("long") * 31 + b * 17) % places
    got = intervals.bootstrap_tails(df, ["i"], replicates=100, start=start).collect()
    assert len(got) == 1
    tails = []
    for rep in range(100):
        idx = np.concatenate([np.arange(7) + (rep * 31 + b * 17) % 39 for b in range(7)])[:45]
        tails.append(np.quantile(r[idx], [0.05, 0.95]))
    lo, hi = np.mean(tails, axis=0)
    assert got[0]["low_tail"] == pytest.approx(lo) and got[0]["high_tail"] == pytest.approx(hi)
    p = intervals.prediction_intervals(spark.createDataFrame([(1, 95.0)], "user_id long, predicted double"), spark.createDataFrame([(1, float(lo), float(hi))], "user_id long, low_tail double, high_tail double")).first()
    assert p["ci_upper"] == 100.0 and p["ci_lower"] == pytest.approx(95 + lo)
    with pytest.raises(ValueError):
        intervals.bootstrap_tails(df, ["i"], replicates=10)


# ------------------------------------------------------------------ serving
def forecast(spark, rows):
    return spark.createDataFrame([(1, c, "m", 1, at(d), at(d, h), p, 0.0, 100.0, None, None, None) for c, d, h, p in rows], serving.PREDICTIONS)


def test_settlement(spark):
    p = forecast(spark, [(1000, 0, 1, 60.0), (1001, 1, 30, 60.0), (1002, 2, 1, 60.0)])
    pending = serving.settle(p, history(spark, [70, None, 40]))
    got = {r["cycle_id"]: (r["target_cycle_id"], r["actual_value"], r["error"]) for r in pending.collect()}
    assert got == {1000: (1001, None, None), 1001: (None, None, None), 1002: (None, None, None)}
    late = {r["cycle_id"]: (r["actual_value"], r["error"]) for r in serving.settle(pending, history(spark, [70, 50, 40])).collect()}
    assert late[1000] == (50.0, 10.0)


def test_first_forecast_wins(spark):
    old = forecast(spark, [(1000, 0, 1, 60.0)])
    new = serving.save_predictions(old, forecast(spark, [(1000, 0, 1, 10.0), (1001, 1, 1, 20.0), (1001, 1, 2, 30.0)])).collect()
    assert [(r["cycle_id"], r["predicted_value"]) for r in new] == [(1001, 20.0)]
    with pytest.raises(contracts.ContractError):
        serving.save_predictions(old, forecast(spark, [(1, 0, 0, 101.0)]))
    assert [r["cycle_id"] for r in serving.prediction_records(old, "m").collect()] == [1000]


def test_daily_update_for_all_users(spark, tmp_path):
    store = tables.Store(spark, f"file://{tmp_path}/models")
    rng = np.random.default_rng(8)
    scores = {u: [float(x) for x in rng.integers(20, 95, 110)] for u in (1, 2)}
    h = history(spark, scores[1][:100]).unionByName(history(spark, scores[2][:100], user=2)).unionByName(history(spark, [50.0] * 30, user=3, day0=70))
    h = h.unionByName(history(spark, [50.0] * 95, user=4, day0=-30))
    now = dt.datetime(2024, 3, 1, tzinfo=UTC) + dt.timedelta(days=99, hours=6)
    args = {"data_kind": "synthetic", "replicates": 100}
    first = {r["user_id"]: r for r in serving.update_daily(store, h, now, **args).collect()}
    assert [first[u]["status"] for u in (1, 2, 3, 4)] == ["predicted", "predicted", "skipped", "skipped"]
    assert first[1]["reason"] == "initial_training" and first[3]["reason"] == "insufficient_history" and first[4]["reason"] == "stale_or_future_features"
    assert first[1]["ci_lower"] <= first[1]["predicted"] <= first[1]["ci_upper"]
    again = {r["user_id"]: r["status"] for r in serving.update_daily(store, h, now, **args).collect()}
    assert again[1] == "already_predicted" and store.read("predictions").count() == 2
    h2 = history(spark, scores[1][:108]).unionByName(history(spark, scores[2][:101], user=2))
    later = {r["user_id"]: r for r in serving.update_daily(store, h2, now + dt.timedelta(days=8), **args).collect()}
    assert later[1]["status"] == "predicted" and later[1]["model_version"] == 2 and later[1]["updated"]
    assert later[2]["status"] == "skipped"
    assert store.read("predictions").where("actual_value is not null").count() == 2
    off = serving.update_daily(store, h, now, data_kind="real").collect()
    assert {r["status"] for r in off} == {"disabled"}
    v = serving.log_version(store, "ridge", store.read("models_synthetic").select("user_id", "weights"), params={"alpha": "10"})
    serving.activate(store, "ridge", v, dt.datetime(2024, 1, 1))
    assert serving.log_version(store, "ridge", store.read("models_synthetic").select("user_id", "weights")) == 2
    assert serving.active_version(store, "ridge") == 1 and serving.active_version(store, "none") is None


# ------------------------------------------------------------------ the rest
def test_streaming_to_gold(spark, tmp_path):
    from pulsegrain.streaming import run_available

    for t in RECORD_TYPES:
        land(tmp_path / "landing", records()[t], t)
    store = tables.Store(spark, f"file://{tmp_path}/gold")
    run_available(spark, str(tmp_path / "landing"), store, str(tmp_path / "cp"))
    assert store.read("mart_daily_features").count() == 3 and store.manifest()["batches"] == {"landing": 0}
    fixed = records()["cycles"][1] | {"end": iso(2), "score_state": "SCORED", "score": {"strain": 3.0}, "updated_at": iso(6)}
    (tmp_path / "landing" / "cycles" / "late.json").write_text(json.dumps(fixed) + "\n")
    run_available(spark, str(tmp_path / "landing"), store, str(tmp_path / "cp"))
    mart = {r["cycle_id"]: r for r in store.read("mart_daily_features").collect()}
    assert mart[2]["cycle_strain"] == 3.0 and mart[3]["days_since_last_low_strain_day"] == 1
    from pulsegrain.streaming import gold_writer

    (tmp_path / "landing" / "sleep" / "bad.json").write_text('not json\n[1]\n{"cycle_id": 3}\n' + json.dumps(records()["sleep"][0] | {"updated_at": iso(9)}) + "\n")
    run_available(spark, str(tmp_path / "landing"), store, str(tmp_path / "cp"))
    assert sorted(r["raw"] for r in store.read("rejects").collect()) == ["[1]", "not json", '{"cycle_id": 3}'] and store.read("sleep").count() == 2
    version = store.manifest()["version"]
    gold_writer(store, "landing")(spark.createDataFrame([], "type string, raw string"), 2)
    assert store.manifest()["version"] == version  # a replay


def test_exact_quantiles(spark):
    from pulsegrain.operators.quantiles import exact_quantiles

    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=3000), rng.normal(size=500) * 1e12, np.full(700, 0.125), [1e-300, -1e-300, 1.7e308, -1.7e308]])
    rows = [(float(v), int(i % 5), None) for i, v in enumerate(rng.permutation(x))] + [(None, None, None), (float("nan"), None, None), (float("inf"), None, None)]
    shares = [0.0, 0.03, 0.25, 0.5, 0.97, 1.0]
    got = exact_quantiles(spark.createDataFrame(rows, "x double, k int, none double"), ["x", "k", "none"], shares)
    s = np.sort(x)
    for q, v in zip(shares, got["x"]):
        at = (len(s) - 1) * q
        a, b = s[int(np.floor(at))], s[int(np.ceil(at))]
        assert v == pytest.approx(a + (b - a) * (at - np.floor(at)))
    assert got["k"] == pytest.approx(np.quantile([i % 5 for i in range(len(x))], shares)) and got["none"] == [None] * 6


def test_quantiles_widen_a_bad_bracket(spark):
    """A sketch too coarse for its brackets costs another scan, not the result."""
    from pulsegrain.operators.quantiles import exact_quantiles

    df = spark.range(20_000).select(((F.col("id") * 7919) % 20_000).cast("double").alias("x"))
    got = exact_quantiles(df, ["x"], [0.1, 0.5, 0.999], accuracy=3)
    assert got["x"] == pytest.approx(np.quantile(np.arange(20_000.0), [0.1, 0.5, 0.999]))


def test_forest_is_walked_as_it_was_grown(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    nodes = anomaly._tree(x[:200], np.random.default_rng(5), 8)

    def plain(v) -> float:
        at = 0
        while nodes[at][0] >= 0:
            f, cut, low, high, _ = nodes[at]
            at = low if v[f] < cut else high
        return nodes[at][4]

    df = spark.createDataFrame([(i, [float(a) for a in r], [tuple(n) for n in nodes]) for i, r in enumerate(x)], f"i int, x array<double>, nodes array<{anomaly.NODE}>")
    got = {r["i"]: r["d"] for r in df.select("i", anomaly.path_length(F.col("nodes"), F.col("x"), 8).alias("d")).collect()}
    assert all(got[i] == pytest.approx(plain(r)) for i, r in enumerate(x))


def test_long_cycles_and_busy_users(spark):
    """Far end dates, open cycles before and within a day, and several lengths at
    once, against all pairs; no cycle is copied often."""
    rng = random.Random(4)
    hour = lambda h: at(0) + dt.timedelta(hours=h)
    cycles = [(u, u * 1000 + i, hour(s), None if rng.random() < 0.2 else hour(s + rng.choice([1, 8, 30, 200, 5_000_000]))) for u in (1, 2) for i in range(60) for s in [rng.uniform(0, 900)]]
    workouts = [(u, f"w{u}-{i}", hour(rng.uniform(-10, 1500))) for u in (1, 2, 3) for i in range(150)]
    c = spark.createDataFrame(cycles, "user_id long, cycle_id long, start_at timestamp, end_at timestamp")
    w = spark.createDataFrame(workouts, "user_id long, workout_id string, start_at timestamp")
    want = {}
    for u, name, t in workouts:
        held = [(s, i) for v, i, s, e in cycles if u == v and s <= t and (e is None or t < e)]
        if held:
            want[name] = max(held)[1]
    assert {r["workout_id"]: r["cycle_id"] for r in daily.assign_workouts(w, c).collect()} == want


def test_sliding_forecasts_match_numpy(spark):
    rng = np.random.default_rng(6)
    raw = [(u, u * 1000 + i, at(i * (1 + u)), float(rng.normal(500, 9)), None if rng.random() < 0.3 else float(rng.normal()), float(rng.uniform(0, 100))) for u in (0, 1) for i in range(140)]
    df = spark.createDataFrame(raw, "user_id long, cycle_id long, start_at timestamp, a double, b double, target double")
    got = {r["cycle_id"]: r["predicted"] for r in learn.sliding_forecasts(df, ("a", "b"), days=40, least=15).collect()}
    want = {}
    for u, i, t, a, b, _ in raw:
        own = [r for r in raw if r[0] == u and t - dt.timedelta(days=40) <= r[2] < t]
        if len(own) < 15:
            continue
        x, y = np.array([[r[3], np.nan if r[4] is None else r[4]] for r in own], float), np.array([r[5] for r in own])
        mean = np.nanmean(x, 0)
        fill = lambda v: np.where(np.isnan(v), mean, v)  # noqa: E731, B023
        scale = fill(x).std(0)
        z = (fill(x) - mean) / scale
        w_ = np.linalg.solve(z.T @ z + 10 * np.eye(2), z.T @ (y - y.mean()))
        want[i] = float(np.clip(y.mean() + (fill(np.array([a, np.nan if b is None else b], float)) - mean) / scale @ w_, 0, 100))
    assert set(got) == set(want) and all(got[i] == pytest.approx(want[i]) for i in want)


def _boosted_plainly(x, y, new, trees, depth, step):
    """One fold's trees, grown row by row: (fit, forecasts of new rows)."""
    fit, out = [sum(y) / len(y)] * len(y), [sum(y) / len(y)] * len(new)

    def grow(rows, at, depth, error):
        total, best = sum(error[i] for i in rows), None
        for j in range(len(x[0])) if depth else ():
            values = sorted({x[i][j] for i in rows})
            for a, b in zip(values, values[1:]):
                low = [error[i] for i in rows if x[i][j] <= a]
                gain = sum(low) ** 2 / len(low) + (total - sum(low)) ** 2 / (len(rows) - len(low)) - total**2 / len(rows)
                if gain > (best[0] if best else 1e-12) * (1 + 1e-9):
                    best = (gain, j, (a + b) / 2)
        if best is None:
            for i in rows:
                fit[i] += step * total / len(rows)
            for i in at:
                out[i] += step * total / len(rows)
            return
        _, j, cut = best
        for side in (lambda v: v <= cut, lambda v: v > cut):
            grow([i for i in rows if side(x[i][j])], [i for i in at if side(new[i][j])], depth - 1, error)

    for _ in range(trees):
        grow(list(range(len(y))), list(range(len(new))), depth, [a - b for a, b in zip(y, fit)])
    return out


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_folds_boosted_together_are_folds_boosted_one_by_one(depth):
    rng = np.random.default_rng(depth)
    x, n = rng.integers(0, 12, (70, 3)).astype(float), 70
    x[:, 1] = rng.normal(size=n)
    x[rng.random(n) < 0.2, 0], x[:, 2] = np.nan, 4.0  # nulls, and a feature that never changes
    y = 3 * np.nan_to_num(x[:, 0]) + rng.normal(size=n)
    train = np.arange(n)[None] < np.array([2, 20, 41, 60])[:, None]
    filled = learn._filled(x, train)
    got = learn.boosted_forecasts(filled, y, train, 12, depth, 0.2)
    for k, own in enumerate(train):
        middle = np.nanmedian(x[own, 0]) if np.isfinite(x[own, 0]).any() else 0.0
        assert np.array_equal(filled[k, :, 0], np.where(np.isnan(x[:, 0]), middle, x[:, 0]))
        want = _boosted_plainly(filled[k, own].tolist(), y[own].tolist(), filled[k].tolist(), 12, depth, 0.2)
        assert np.allclose(got[k], want, atol=1e-9)


def test_classifier_and_boosted_folds(spark, tmp_path):
    rng = np.random.default_rng(1)
    raw = []
    for user, level in ((1, 0.5), (2, 3.0)):
        for i in range(110):
            a, b = rng.normal(size=2)
            # user 2 has one class in the first training rows
            low = int(a + 0.3 * rng.normal() > level) if user == 1 or i > 80 else 0
            raw.append((user, i, at(i), float(a), None if i % 9 == 0 else float(b), 50 + 10 * float(np.sign(a)) + float(rng.normal()), low))
    df = spark.createDataFrame(raw, "user_id long, cycle_id long, start_at timestamp, a double, b double, target double, low_recovery int")
    rows = folds.fold_rows(df)
    status = {(r["user_id"], r["fold"]): r["skipped"] for r in folds.fold_status(rows).collect()}
    out = learn.validate_low_recovery(rows, ("a", "b")).collect()
    assert {(r["user_id"], r["fold"]) for r in out} == {k for k, skipped in status.items() if not skipped} and any(status.values())
    mine = [r for r in out if r["user_id"] == 1]
    assert np.mean([(r["probability"] > 0.5) == (r["low_recovery"] == 1) for r in mine]) > 0.8
    boosted = learn.validate_boosted(rows.where("user_id = 1"), ("a", "b")).collect()
    assert np.mean([abs(r["predicted"] - r["target"]) for r in boosted]) < 4 and all(0 <= r["predicted"] <= 100 for r in boosted)
    store = tables.Store(spark, f"file://{tmp_path}/suite")
    some = rows.where("user_id = 1").withColumn("recovery_score", F.col("a"))
    for version in (1, 2):
        assert serving.log_suite(store, some, ("a", "b"), ("persistence", "ridge")) == {"synthetic-persistence": version, "synthetic-ridge": version}
    assert {(r["model_name"], r["model_version"]) for r in store.read("fold_metrics").collect()} == {(f"synthetic-{m}", v) for m in ("persistence", "ridge") for v in (1, 2)}
    whole = learn.compare_models(rows.withColumn("recovery_score", F.col("a")), ("a", "b"))
    assert {r["model_name"] for r in whole.collect()} == {"persistence", "ridge", "incremental_ridge", "boosted"}


def test_explore_helpers(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, at(0), 5.0), (1, 2, at(1), 7.0), (1, 3, at(2), 9.0), (1, 4, at(3), None)], "user_id long, cycle_id long, start_at timestamp, x double")
    assert explore.histogram(df, "x", 2).orderBy("bin").select("n").collect() == [(1,), (2,)]
    assert explore.histogram(df.withColumn("x", F.lit(1.0)), "x").first()["n"] == 4
    assert explore.lag_correlation(df, "x").first()["correlation"] == pytest.approx(1.0)
    assert explore.above(df, "x", 6).count() == 2 and explore.preview(df, ["cycle_id"], 2).count() == 2
    assert features.recent_rows(df, 2).count() == 2
    assert features.strain_stability(df.withColumn("cycle_strain", F.col("x"))).count() == 4
    assert explore.describe(df).count() == 4
    explore.replace_table(df, "kept_rows")
    explore.replace_table(df, "kept_rows")
    assert "kept_rows" in explore.list_tables(spark)
    assert conform(df, "cycles").columns == [c for c, _, _ in SILVER["cycles"]]
    assert df.select(*one_hot_weekday(F.col("start_at"))).first()["is_day_5"] == 1


def test_lag_correlation_of_a_constant_series(spark):
    values = {1: [4.0] * 5, 2: [1.0, 1.0, 1.0, 9.0], 3: [1.0, None, 2.0], 4: [3.0], 5: [1.0, 5.0, 2.0, None, 7.0, 3.0, 4.0]}
    rows = [(u, i, at(i), x) for u, xs in values.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "user_id long, cycle_id long, start_at timestamp, x double")
    got = {r["user_id"]: r for r in explore.lag_correlation(df, "x").collect()}
    assert [got[u]["correlation"] for u in (1, 2, 3, 4)] == [None] * 4
    assert got[5]["correlation"] == pytest.approx(np.corrcoef([1, 5, 7, 3], [5, 2, 3, 4])[0, 1])
    assert [(got[u]["pairs"], got[u]["both"]) for u in values] == [(4, 4), (3, 3), (1, 0), (0, 0), (5, 4)]


def test_forest_walk_takes_batches():
    x = np.random.default_rng(3).normal(size=(300, 3))
    trees = [anomaly._tree(x, np.random.default_rng(t), 8) for t in range(5)]

    def walk(nodes, row):
        at = 0
        while nodes[at][0] >= 0:
            at = nodes[at][2] if row[nodes[at][0]] < nodes[at][1] else nodes[at][3]
        return nodes[at][4]

    got = anomaly.path_lengths([tuple(np.array(v) for v in zip(*t)) for t in trees], x, 8)
    assert got.tolist() == pytest.approx([sum(walk(t, row) for t in trees) for row in x], rel=1e-12)
