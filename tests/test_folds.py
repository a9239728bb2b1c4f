"""Walk-forward folds, each row once, against folds written out."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrain.operators import folds, learn

START = dt.datetime(2024, 1, 1)
SCHEMA = "user_id long, cycle_id long, start_at timestamp, target_start_at timestamp, target double, low_recovery int, a double, b double, c double, d double"
FEATURES = ("a", "b", "c", "d")


def made(seed: int = 0, sizes: dict | None = None) -> list[tuple]:
    """A user's rows are out of order; b has gaps, c is missing at first and d constant for long."""
    rng = np.random.default_rng(seed)
    out = []
    for user, n in (sizes or {1: 131, 2: 88, 3: 89, 4: 400}).items():
        for i in range(n):
            a, t = float(rng.normal(1000, 50)), START + dt.timedelta(days=i * (3 if user == 4 else 1))
            b, c = None if rng.random() < 0.3 else float(rng.normal()), None if i < 70 else float(rng.normal())
            out.append((user, user * 1000 + i, t, t + dt.timedelta(days=1), float(np.clip(50 + (a - 1000) / 5 + rng.normal() * 9, 0, 100)), int(rng.random() < (0.3 if user != 3 or i > 65 else 0)), a, b, c, 7.25 if i < 100 else 8.5))
    rng.shuffle(out)
    return [tuple(None if v is None else v for v in r) for r in out]


def plain(rows: list[tuple], initial=60, test=14, gap=1) -> dict:
    """{(user, fold): (train, purged, test)} with rows in their order."""
    out = {}
    for user in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == user), key=lambda r: (r[2], r[1]))
        count = (len(own) - initial - gap) // test
        for k in range(count if count >= 2 else 0):
            s = initial + gap + k * test
            out[user, k] = own[: s - gap], own[s - gap : s], own[s : s + test]
    return out


def matrix(rows: list[tuple]) -> np.ndarray:
    return np.array([[np.nan if v is None else v for v in r[6:10]] for r in rows], float)


def prepared(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    middle = np.array([np.median(c[~np.isnan(c)]) if (~np.isnan(c)).any() else 0.0 for c in x.T])
    x = np.where(np.isnan(x), middle, x)
    scale = x.std(0)
    return middle, x.mean(0), np.where(scale > 1e-9, scale, 1.0)


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("sizes", [(60, 14, 1), (30, 5, 0), (20, 3, 10)])
def test_roles(spark, rows, table, sizes):
    want = {}
    for (user, k), parts in plain(rows, *sizes).items():
        for role, own in zip(("train", "purged", "test"), parts):
            if own:
                ids = [r[1] for r in own]
                want[user, k, role] = (len(ids), min(ids), max(ids))
    once = folds.fold_rows(table, *sizes)
    assert {tuple(r[:3]): tuple(r[3:]) for r in folds.fold_summary(once).collect()} == want
    users = {u for u, _, _ in want}
    assert once.count() == sum(r[0] in users for r in rows) == once.select("cycle_id").distinct().count()
    index = {r["cycle_id"]: r["row_index"] for r in once.collect()}
    assert all(index[i] == i % 1000 for i in index)


def test_sizes_leaks_and_classes(spark, rows, table):
    with pytest.raises(ValueError):
        folds.fold_rows(table, initial=1)
    assert folds.fold_rows(table.where("user_id = 2")).count() == 0 and folds.fold_rows(table.limit(0)).count() == 0
    once = folds.fold_rows(table)
    assert folds.leaking_folds(once).count() == 0
    late = folds.fold_rows(table.withColumn("target_start_at", F.when(F.col("cycle_id") == 1010, F.lit(START + dt.timedelta(days=80))).otherwise(F.col("target_start_at"))))
    assert sorted(r["fold"] for r in folds.leaking_folds(late).collect()) == [0, 1]
    status = {(r["user_id"], r["fold"]): r["skipped"] for r in folds.fold_status(once).collect()}
    assert status == {k: len({r[5] for r in train}) < 2 for k, (train, _, _) in plain(rows).items()} and any(status.values())


@pytest.mark.parametrize("frozen", [False, True])
def test_fold_models_match_numpy(spark, rows, table, frozen):
    got = {(r["user_id"], r["fold"]): r for r in learn.fold_models(folds.fold_rows(table), FEATURES, frozen=frozen).collect()}
    want = plain(rows)
    assert set(got) == set(want)
    for (user, k), (train, _, _) in want.items():
        x, y, r = matrix(train), np.array([t[4] for t in train]), got[user, k]
        middle, mean, scale = prepared(matrix(want[user, 0][0])) if frozen else prepared(x)
        z = (np.where(np.isnan(x), middle, x) - mean) / scale
        w = np.linalg.solve((z - z.mean(0)).T @ (z - z.mean(0)) + 10 * np.eye(4), (z - z.mean(0)).T @ y)
        assert r["n"] == len(train) and r["medians"] == pytest.approx(middle) and r["means"] == pytest.approx(mean) and r["scales"] == pytest.approx(scale)
        assert r["weights"] == pytest.approx(w, abs=1e-8) and r["intercept"] == pytest.approx(y.mean() - w @ z.mean(0), abs=1e-7)


def test_classifiers_match_numpy(spark, rows, table):
    """Balanced logistic regression of every fold, to a millionth."""
    got = {(r["user_id"], r["cycle_id"]): (r["fold"], r["probability"]) for r in learn.validate_low_recovery(folds.fold_rows(table), FEATURES).collect()}
    want = {}
    for (user, k), (train, _, test) in plain(rows).items():
        y = np.array([t[5] for t in train], float)
        if y.min() == y.max():
            continue
        middle, mean, scale = prepared(matrix(train))
        form = lambda rs: np.c_[(np.where(np.isnan(matrix(rs)), middle, matrix(rs)) - mean) / scale, np.ones(len(rs))]  # noqa: E731, B023
        z, share, w = form(train), np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))), np.zeros(5)
        penalty = np.array([1, 1, 1, 1, 1e-9])
        for _ in range(60):
            p = 1 / (1 + np.exp(-z @ w))
            w -= np.linalg.solve((z * (share * p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (share * (p - y)) + penalty * w)
        for t, p in zip(test, 1 / (1 + np.exp(-form(test) @ w))):
            want[user, t[1]] = (k, p)
    assert set(got) == set(want) and len(want) < sum(len(t) for _, _, t in plain(rows).values())
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1], abs=1e-6) for i in want)
