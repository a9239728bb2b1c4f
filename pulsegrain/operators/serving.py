"""Forecast tables: first-write-wins saves, settlement, and the daily update of
every user in one job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import materialise
from .contracts import ContractError, outside
from .features import FEATURES, user_line
from .folds import fold_rows
from .intervals import bootstrap_tails, prediction_intervals
from .learn import fit_ridge, predict_ridge, suite_metrics, update_ridge, validate_ridge
from .monitor import error_windows, retrain_decision
from .staging import staged
from .supervised import readiness, supervised_pairs
from .tables import Store, Transaction, insert_new

PREDICTIONS = (
    "user_id bigint, cycle_id bigint, model_name string, model_version int, origin_at timestamp, created_at timestamp, predicted_value double, ci_lower double, ci_upper double, "
    "target_cycle_id bigint, actual_value double, error double"
)
KEY = ["cycle_id", "model_name"]


def prediction_violations(predictions: DataFrame) -> DataFrame:
    """Rows with a value outside [0, 100], an interval that does not hold its
    forecast, or a null in what every forecast has."""
    c = F.col
    bad = outside(c("predicted_value"), 0, 100) | outside(c("ci_lower"), 0, 100) | outside(c("ci_upper"), 0, 100) | outside(c("actual_value"), 0, 100)
    order = F.coalesce((c("ci_lower") > c("predicted_value")) | (c("predicted_value") > c("ci_upper")), F.lit(True))
    nulls = c("cycle_id").isNull() | c("model_name").isNull() | c("origin_at").isNull() | c("created_at").isNull()
    return predictions.where(bad | order | nulls)


def save_predictions(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """The rows of `new` to insert: the first forecast of a cycle and model
    stays for good. Bad rows fail the whole batch."""
    if prediction_violations(new).limit(1).count():
        raise ContractError("forecasts out of range")
    return insert_new(existing, new, KEY, ["created_at", "predicted_value"])


def prediction_records(predictions: DataFrame, model_name: str) -> DataFrame:
    """Forecasts of a model in the order of their origins."""
    return predictions.where(F.col("model_name") == model_name).orderBy("origin_at", "user_id", "cycle_id")


def settle(predictions: DataFrame, history: DataFrame, model_name: str | None = None) -> DataFrame:
    """Outcome columns from the cycle right after each forecast's. A pending
    outcome is null, a corrected one replaces the old; a forecast that was made
    when its target had begun, or has no next cycle, is left as it is. Nothing
    but the outcome changes."""
    w = user_line()
    nxt = history.select("user_id", "cycle_id", F.lead("cycle_id").over(w).alias("__id"), F.lead("start_at").over(w).alias("__at"), F.lead("recovery_score").over(w).cast("double").alias("__score")).where("__id is not null")
    out = predictions.join(nxt, ["user_id", "cycle_id"], "left")
    due = F.col("__id").isNotNull() & (F.col("created_at") < F.col("__at"))
    due = F.coalesce(due & (F.col("model_name") == model_name) if model_name else due, F.lit(False))
    new = {"target_cycle_id": F.col("__id"), "actual_value": F.col("__score"), "error": F.col("predicted_value") - F.col("__score")}
    return out.select(*[F.when(due, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in predictions.columns])


# ---------------------------------------------------------------- experiments
def log_version(store: Store, name: str, models: DataFrame, fold_metrics: DataFrame | None = None, params: dict[str, str] | None = None) -> int:
    """Append a model table (weights as arrays) and its fold metrics under the
    next version of `name`; returns the version. Two writers get two versions."""

    def log(tx) -> int:
        old = tx.read("model_versions")
        last = None if old is None else old.where(F.col("model_name") == name).agg(F.max("model_version")).first()[0]
        version = (last or 0) + 1
        tag = lambda df: df.withColumns({"model_name": F.lit(name), "model_version": F.lit(version)})
        noted = F.create_map(*[F.lit(x) for kv in sorted(params.items()) for x in kv]) if params else F.lit(None).cast("map<string,string>")
        tx.append("model_versions", tag(models).withColumn("params", noted))
        if fold_metrics is not None:
            tx.append("fold_metrics", tag(fold_metrics))
        return version

    return store.update(log)


def log_suite(store: Store, rows: DataFrame, features: tuple[str, ...] = FEATURES, models: tuple[str, ...] = ("persistence", "ridge", "incremental_ridge", "boosted"), data_kind: str = "synthetic") -> dict[str, int]:
    """Compare several forecasters over the same folds: the fold metrics of all
    are committed together, each under the next version of <data_kind>-<model>;
    returns the versions."""
    made = materialise(suite_metrics(rows, features, models).withColumn("model_name", F.concat(F.lit(f"{data_kind}-"), "model_name")), "suite")

    def log(tx) -> dict[str, int]:
        old = tx.read("fold_metrics")
        last = {} if old is None else {r[0]: r[1] for r in old.groupBy("model_name").agg(F.max("model_version")).collect()}  # a row for each model
        versions = {f"{data_kind}-{m}": (last.get(f"{data_kind}-{m}") or 0) + 1 for m in models}
        version = F.element_at(F.create_map(*[F.lit(x) for kv in versions.items() for x in kv]), F.col("model_name"))
        tx.append("fold_metrics", made.select("user_id", "model_name", version.alias("model_version"), "fold", "metric", "value"))
        return versions

    return store.update(log)


def activate(store: Store, name: str, version: int, at: dt.datetime) -> None:
    store.append("activations", store.spark.createDataFrame([(name, version, at)], "model_name string, model_version int, activated_at timestamp"))


def active_version(store: Store, name: str) -> int | None:
    """The version activated last, None without any."""
    log = store.read("activations")
    if log is None:
        return None
    got = log.where(F.col("model_name") == name).agg(F.max_by("model_version", F.struct("activated_at", "model_version"))).first()
    return got[0]


# ---------------------------------------------------------------- daily update
def update_daily(store: Store, history: DataFrame, now: dt.datetime, *, data_kind: str, allow_real: bool = False, model_name: str | None = None, replicates: int = 1000, min_pairs: int = 90, min_days: int = 89, splits: dict | None = None, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """One forecast for each user's latest cycle; returns (user_id, status,
    reason, updated, cycle_id, model_version, predicted, ci_lower, ci_upper).

    Settles outcomes, then for each user: skipped (stale or future features,
    too little history), already_predicted, or predicted after a full fit (the
    first one and emergencies), an incremental one, or none (stable, or no new
    labels). Model state, forecasts and outcomes are one transaction, so a
    failed run changes nothing, a repeated one predicts nothing twice, and one
    that another overtakes runs again. Rows that stay as they are are not
    written again.
    """
    status = "user_id bigint, status string, reason string, updated boolean, cycle_id bigint, model_version int, predicted double, ci_lower double, ci_upper double"
    if now.tzinfo is None:
        raise ValueError("now must have a time zone")
    if data_kind == "real" and not allow_real:
        return history.select("user_id").distinct().select("user_id", F.lit("disabled").alias("status"), F.lit("real_training_requires_deliberate_opt_in").alias("reason"), *[F.lit(None).cast(t).alias(n) for n, t in (("updated", "boolean"), ("cycle_id", "bigint"), ("model_version", "int"), ("predicted", "double"), ("ci_lower", "double"), ("ci_upper", "double"))])
    name = model_name or f"{data_kind}-recovery-ridge-daily"
    out = store.update(lambda tx: _update(tx, history, now, name, f"models_{data_kind}", replicates, min_pairs, min_days, splits, features))
    assert [f.name for f in out.schema] == [c.split()[0] for c in status.split(", ")]
    return out


def _update(tx: Transaction, history: DataFrame, now: dt.datetime, name: str, table: str, replicates: int, min_pairs: int, min_days: int, splits: dict | None, features: tuple[str, ...]) -> DataFrame:
    store, spark = tx.store, tx.store.spark
    at = F.lit(now)
    user = ["user_id"]
    latest = history.withColumn("__r", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("start_at"), F.desc("cycle_id")))).where("__r = 1").drop("__r")
    age = F.unix_micros(at) - F.unix_micros(F.col("start_at").cast("timestamp"))
    pairs = supervised_pairs(history)
    ready = readiness(pairs, min_pairs, min_days)

    old = tx.read("predictions")
    old = spark.createDataFrame([], PREDICTIONS) if old is None else old
    settled = settle(old, history, name)
    mine = settled.where(F.col("model_name") == name)
    models = tx.read(table)
    state = latest.select("user_id", "cycle_id", "start_at", ((age >= 0) & (age <= 2 * 86400 * 1_000_000)).alias("fresh")).join(ready, user, "left")
    state = state.join(mine.select("user_id", "cycle_id").withColumn("__done", F.lit(True)), ["user_id", "cycle_id"], "left")
    known = models.select("user_id", "trained_through", "updated_at", "model_version") if models is not None else spark.createDataFrame([], "user_id bigint, trained_through timestamp, updated_at timestamp, model_version int")
    state = state.join(known, user, "left").join(pairs.groupBy("user_id").agg(F.max("target_start_at").alias("newest")), user, "left")
    state = state.join(error_windows(mine.select("user_id", "error", "origin_at", "cycle_id"), ["origin_at", "cycle_id"]), user, "left").withColumn("n_errors", F.coalesce("n_errors", F.lit(0)))
    days = F.floor((F.unix_seconds(at) - F.unix_seconds("updated_at")) / 86400)
    state = retrain_decision(state.withColumn("days_since_update", F.greatest(F.lit(0), F.coalesce(days, F.lit(0)))))
    kind = (
        F.when(~F.col("fresh"), "stale_or_future_features").when(~F.coalesce("ready", F.lit(False)), "insufficient_history").when(F.col("__done"), "already_predicted")
        .when(F.col("updated_at").isNull(), "initial_training").when(F.col("newest") <= F.col("trained_through"), "no_new_labels").otherwise(F.col("reason"))
    )
    state = state.withColumn("reason", kind).withColumn("method", F.when(F.col("reason").isin("initial_training", "emergency"), "full").when(F.col("reason").isin("bias_correction", "drift_correction", "routine"), "partial").when(F.col("reason").isin("stable", "no_new_labels"), "none"))
    state = staged(state, store, "state")
    chosen = lambda m: state.where(F.col("method") == m).select("user_id")
    meta = lambda df: df.join(state.select("user_id", F.col("newest").alias("trained_through"), F.coalesce(F.col("model_version") + 1, F.lit(1)).alias("model_version")), user).withColumn("updated_at", at)
    full = meta(fit_ridge(pairs.join(chosen("full"), user, "left_semi"), user, features))
    fresh = full
    if models is not None:
        base = models.join(chosen("partial"), user, "left_semi")
        new = pairs.join(base.select("user_id", F.col("trained_through").alias("__t")), user).where(F.col("target_start_at") > F.col("__t")).drop("__t")
        core = [c for c in models.columns if c not in ("trained_through", "updated_at", "model_version", "low_tail", "high_tail")]
        fresh = full.unionByName(meta(update_ridge(base.select(*core), new, user, features)))
    # intervals rest on a fresh walk-forward fit of the users that are updated
    folds = fold_rows(pairs.join(state.where("method in ('full', 'partial')"), user, "left_semi"), **(splits or {}))
    tails = bootstrap_tails(validate_ridge(folds, features).select("user_id", "residual", "fold", "row_index"), ["fold", "row_index"], replicates=replicates)
    fresh = fresh.join(tails.select("user_id", "low_tail", "high_tail"), user, "left")
    fresh = staged(fresh, store, "models")
    all_models = fresh if models is None else models.join(fresh.select("user_id"), user, "left_anti").unionByName(fresh)

    point = predict_ridge(latest.join(state.where("method is not null").select("user_id"), user, "left_semi"), all_models, user, features)
    point = prediction_intervals(point, all_models.where("low_tail is not null").select("user_id", "low_tail", "high_tail"))
    point = point.join(all_models.select("user_id", "model_version"), user)
    none = lambda t: F.lit(None).cast(t)
    rows = point.select(
        "user_id", "cycle_id", F.lit(name).alias("model_name"), "model_version", F.col("start_at").cast("timestamp").alias("origin_at"), at.cast("timestamp").alias("created_at"), F.col("predicted").alias("predicted_value"), "ci_lower", "ci_upper",
        none("bigint").alias("target_cycle_id"), none("double").alias("actual_value"), none("double").alias("error"),
    )
    rows = staged(rows, store, "forecasts")
    outcome = ["target_cycle_id", "actual_value", "error"]
    before = old.select(*KEY, *[F.col(c).alias(f"__{c}") for c in outcome])
    same = F.lit(True)
    for c in outcome:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    changed = settled.join(before, KEY).where(~same).select(*settled.columns)
    tx.merge("predictions", changed.unionByName(save_predictions(settled, rows)), KEY)
    tx.merge(table, fresh, "user_id")
    made = rows.select("user_id", "model_version", F.col("predicted_value").alias("predicted"), "ci_lower", "ci_upper")
    out = state.drop("model_version").join(made, user, "left")
    label = F.when(F.col("predicted").isNotNull(), "predicted").when(F.col("reason") == "already_predicted", "already_predicted").otherwise("skipped")
    reason = F.when(F.col("method").isNotNull() & F.col("predicted").isNull(), "too_few_residuals").when(F.col("reason") == "already_predicted", None).otherwise(F.col("reason"))
    out = out.select("user_id", label.alias("status"), reason.alias("reason"), (F.col("method").isin("full", "partial")).alias("updated"), "cycle_id", "model_version", "predicted", "ci_lower", "ci_upper")
    return staged(out, store, "status")
