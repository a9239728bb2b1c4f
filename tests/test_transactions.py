"""Writers that overtake one another, and transactions that end half way."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pulsegrain.operators import serving, tables
from pulsegrain.streaming import gold_writer

NOW = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)


class Overtaken:
    """Runs `other` once, just before a store publishes its first manifest."""

    def __init__(self, monkeypatch, store, other):
        real, done = tables.Store._publish, []

        def publish(this, manifest):
            if this is store and not done:
                done.append(1)
                other()
            return real(this, manifest)

        monkeypatch.setattr(tables.Store, "_publish", publish)
        self.done = done


@pytest.fixture
def two(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    return tables.Store(spark, root, buckets=2), tables.Store(spark, root, buckets=2)


def test_activations_keep_both(two, monkeypatch):
    one, other = two
    serving.activate(one, "a", 1, NOW)
    Overtaken(monkeypatch, one, lambda: serving.activate(other, "b", 2, NOW))
    serving.activate(one, "c", 3, NOW)
    assert {(r["model_name"], r["model_version"]) for r in one.read("activations").collect()} == {("a", 1), ("b", 2), ("c", 3)}
    assert serving.active_version(one, "b") == 2


def test_versions_are_given_once(spark, two, monkeypatch):
    one, other = two
    models = spark.createDataFrame([(1, [0.5])], "user_id long, weights array<double>")
    Overtaken(monkeypatch, one, lambda: serving.log_version(other, "m", models.withColumn("extra", F.lit(1))))
    assert serving.log_version(one, "m", models, models.select("user_id")) == 2
    rows = one.read("model_versions").collect()
    assert sorted(r["model_version"] for r in rows) == [1, 2] and {r["model_version"]: r["extra"] for r in rows} == {1: 1, 2: None}
    assert one.read("fold_metrics").count() == 1


def test_suites_are_versioned_once(spark, two, monkeypatch):
    one, other = two
    rows = spark.range(40).select(F.lit(1).cast("long").alias("user_id"), F.col("id").alias("cycle_id"), (F.col("id") % 7).cast("double").alias("recovery_score"), (F.col("id") % 5).cast("double").alias("target"), F.when(F.col("id") >= 20, 0).cast("int").alias("fold"), F.lit(0).alias("block"), F.lit(None).cast("int").alias("purged"), F.lit(None).cast("int").alias("last_purged"))
    log = lambda s: serving.log_suite(s, rows, ("recovery_score",), ("persistence",))
    Overtaken(monkeypatch, one, lambda: log(other))
    assert log(one) == {"synthetic-persistence": 2}
    versions = one.read("fold_metrics").groupBy("model_version").count().collect()
    assert sorted(r["model_version"] for r in versions) == [1, 2] and len({r["count"] for r in versions}) == 1


def test_daily_update_runs_again(spark, two, monkeypatch):
    """The run that is overtaken finds the other's forecasts and makes none twice."""
    from pulsegrain.operators import features

    one, other = two
    days = [(NOW - dt.timedelta(days=120 - i)).replace(tzinfo=None) for i in range(121)]
    history = spark.createDataFrame([(u, u * 1000 + i, d, float((i * 37 + u) % 101)) for u in (1, 2) for i, d in enumerate(days)], "user_id long, cycle_id long, start_at timestamp, recovery_score double")
    history = history.withColumns({f: F.col("recovery_score") if f == "recovery_score" else F.pmod(F.xxhash64("cycle_id", F.lit(f)), F.lit(50)).cast("double") for f in features.FEATURES})
    run = lambda s, h: {r["user_id"]: r for r in serving.update_daily(s, h, NOW, data_kind="test", replicates=100).collect()}
    found = {}
    Overtaken(monkeypatch, one, lambda: found.update(run(other, history.where("user_id = 1"))))
    again = run(one, history)
    assert found[1]["status"] == "predicted" and again[1]["status"] == "already_predicted" and again[2]["status"] == "predicted"
    kept = {r["user_id"]: r["predicted_value"] for r in one.read("predictions").collect()}
    assert set(kept) == {1, 2} and kept[1] == found[1]["predicted"]
    assert {r["user_id"] for r in one.read("models_test").collect()} == {1, 2}


def test_reads_are_checked_and_writes_seen(spark, two, monkeypatch):
    one, other = two
    one.commit({"a": spark.range(3), "b": spark.range(1)})
    seen = []

    def total(tx):
        seen.append(tx.read("a").count())
        tx.write("sum", spark.range(seen[-1]))
        assert tx.read("sum").count() == seen[-1] and other.read("sum") is None
        return seen[-1]

    Overtaken(monkeypatch, one, lambda: (other.commit({"a": spark.range(5)}), other.commit({"b": spark.range(2)})))
    assert one.update(total) == 5 and seen == [3, 5] and one.read("sum").count() == 5 and one.read("b").count() == 2


def test_buckets_grow(spark, tmp_path):
    store = tables.Store(spark, f"file://{tmp_path}/grown", buckets=2, part_bytes=6_000)
    rows = lambda lo, hi, v: spark.range(lo, hi).select("id", F.lit(v).alias("v"))
    store.merge({"t": (rows(0, 5_000, 1), "id")})
    assert store.manifest()["tables"]["t"]["buckets"] == 2
    store.merge({"t": (rows(4_999, 5_001, 2), "id")})
    entry = store.manifest()["tables"]["t"]
    assert entry["buckets"] >= 8 and len(entry["parts"]) == entry["buckets"]
    store.merge({"t": (rows(10, 11, 3), "id")})
    after = store.manifest()["tables"]["t"]
    assert sum(after["parts"][k] != entry["parts"][k] for k in entry["parts"]) == 1
    got = {r["id"]: r["v"] for r in store.read("t").collect()}
    assert len(got) == 5_001 and got[10] == 3 and got[4_999] == 2 and got[0] == 1
    store.merge({"t": (spark.createDataFrame([(7, 9)], "id long, v int"), ["id", "v"])})  # another key
    assert store.read("t").where("id = 7").count() == 2


@pytest.mark.parametrize("at", ["rejects", "cycles", "workouts", "mart_daily_features"])
def test_a_batch_that_fails_leaves_nothing(spark, tmp_path, monkeypatch, at):
    store = tables.Store(spark, f"file://{tmp_path}/gold", buckets=2)
    cycle = {"id": 1, "user_id": 5, "created_at": "2024-03-01T00:00:00Z", "updated_at": "2024-03-01T09:00:00Z", "start": "2024-03-01T00:00:00Z", "end": "2024-03-01T08:00:00Z", "timezone_offset": "+00:00", "score_state": "SCORED", "score": {"strain": 3.0, "kilojoule": 1.0, "average_heart_rate": 60, "max_heart_rate": 90}}
    batch = spark.createDataFrame([("cycles", json.dumps(cycle)), ("cycles", "no json")], "type string, raw string")
    with monkeypatch.context() as m:
        for name in ("merge", "append"):
            real = getattr(tables.Transaction, name)

            def fails(tx, table, *rest, real=real):
                if table == at:
                    raise OSError("lost")
                return real(tx, table, *rest)

            m.setattr(tables.Transaction, name, fails)
        with pytest.raises(OSError):
            gold_writer(store, "s")(batch, 0)
    assert store.manifest()["version"] == 0
    gold_writer(store, "s")(batch, 0)
    gold_writer(store, "s")(batch, 0)
    assert store.manifest()["version"] == 1 and store.manifest()["batches"] == {"s": 0}
    assert store.read("rejects").count() == 1 and store.read("mart_daily_features").first()["cycle_strain"] == 3.0
