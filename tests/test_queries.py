"""Every registered query against its DuckDB SQL."""

from __future__ import annotations

import math

import duckdb
import pytest

from pulsegrain.plans import registry

TABLES = "region nation customer supplier part orders lineitem events".split()
#: The smallest tables have too few days for a walk-forward: these use larger ones.
LONG = {"walk_forward_folds", "impute_scale", "fold_metrics", "auc_by_fold", "metric_summary", "ridge_walk_forward", "leaking_folds", "flag_rate", "classifier_folds", "low_recovery_walk_forward", "boosted_walk_forward", "ridge_folds", "incremental_folds", "model_suite", "sliding_forecasts", "daily_update", "isolation_flag_rate"}


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v


def _dir(sf_dir, name):
    return sf_dir.replace("sf0.001", "sf0.01") if name in LONG else sf_dir


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, sf_dir, name):
    sf_dir = _dir(sf_dir, name)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    df = registry.QUERIES[name](spark, sf_dir)
    got = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(_plain(v) for _, v in sorted(zip(names, r))) for r in got.fetchall()), key=repr)
    have = sorted((tuple(_plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
    assert have == want
    assert have


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_has_rows(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, _dir(sf_dir, name)).count() > 0


def test_entry_without_the_training_part(spark, monkeypatch):
    import sys

    import __spark_entry__ as e

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert "daily_summary" in e.queries()
    assert "pipeline" not in e.queries()


def test_entry_tells_of_missing_packages(monkeypatch):
    import sys

    import __spark_entry__ as e

    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("pulsegrain.llm")]:
        monkeypatch.delitem(sys.modules, name)
    try:
        import corpus_pipeline  # noqa: F401
    except ModuleNotFoundError:
        pytest.skip("the training part is not here")
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("pulsegrain.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    with pytest.raises(ModuleNotFoundError):
        e.queries()
