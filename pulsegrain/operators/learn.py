"""Learners: preprocessing and ridge regression for every group at once from
additive sums, and pooled models for all users.

A group (a user, or a user's fold) is a few numbers: sums of products of its
standardised features. They are plain aggregates, they add up when new pairs
arrive, and only the small solve of each group leaves generated code.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clipped
from ..scratch import materialise
from .features import FEATURES
from .folds import running_medians, running_products, sliding_products, test_rows, training, values
from .quantiles import exact_quantiles

ALPHA = 10.0


def fit_preprocessing(train: DataFrame, keys: list[str], features: tuple[str, ...] = FEATURES) -> DataFrame:
    """(keys, medians, means, scales): exact medians that fill nulls (0 where a
    column is all null), then mean and population deviation (0 becomes 1). One
    aggregation: what filling does to both follows from counts and the median."""
    parts = {}
    for i, v in enumerate(values(features)):
        parts |= {f"__p{i}": F.percentile(v, 0.5), f"__c{i}": F.count(v), f"__a{i}": F.avg(v), f"__v{i}": F.var_pop(v)}
    one = train.groupBy(*keys).agg(F.count("*").alias("__n"), *[c.alias(n) for n, c in parts.items()])
    medians, means, scales = [], [], []
    for i in range(len(features)):
        median, own, avg = F.coalesce(f"__p{i}", F.lit(0.0)), F.col(f"__c{i}"), F.coalesce(f"__a{i}", F.lit(0.0))
        filled = F.col("__n") - own
        mean = F.when(filled == 0, avg).otherwise((own * avg + filled * median) / F.col("__n"))
        spread = (own * (F.coalesce(f"__v{i}", F.lit(0.0)) + (avg - mean) ** 2) + filled * (median - mean) ** 2) / F.col("__n")
        medians.append(median)
        means.append(mean)
        scales.append(F.when(spread > 0, F.sqrt(spread)).otherwise(F.lit(1.0)))
    return one.select(*keys, F.array(*medians).alias("medians"), F.array(*means).alias("means"), F.array(*scales).alias("scales"))


def standardise(df: DataFrame, prepared: DataFrame, keys: list[str], features: tuple[str, ...] = FEATURES) -> DataFrame:
    """df with z: its features filled and scaled as `prepared` says."""
    z = [(F.coalesce(v, F.col("medians")[i]) - F.col("means")[i]) / F.col("scales")[i] for i, v in enumerate(values(features))]
    return df.join(prepared.select(*keys, "medians", "means", "scales"), keys).withColumn("z", F.array(*z)).drop("medians", "means", "scales")


def gram(standardised: DataFrame, keys: list[str], size: int, target: str = "target") -> DataFrame:
    """(keys, n, sum_y, sum_z, sum_zy, sum_zz): the group's additive state;
    sum_zz is the upper triangle by rows."""
    z, y = [F.col("z")[i] for i in range(size)], F.col(target).cast("double")
    return standardised.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(y).alias("sum_y"), F.array(*[F.sum(x) for x in z]).alias("sum_z"), F.array(*[F.sum(x * y) for x in z]).alias("sum_zy"),
        F.array(*[F.sum(z[i] * z[j]) for i in range(size) for j in range(i, size)]).alias("sum_zz"),
    )


def solve_ridge(n: float, sum_y: float, sum_z: np.ndarray, sum_zy: np.ndarray, sum_zz: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Weights and intercept (not penalised) from the sums."""
    d = len(sum_z)
    zz = np.zeros((d, d))
    zz[np.triu_indices(d)] = sum_zz
    zz = zz + zz.T - np.diag(np.diag(zz))
    mean, y = sum_z / n, sum_y / n
    w = np.linalg.solve(zz - n * np.outer(mean, mean) + alpha * np.eye(d), sum_zy - n * mean * y)
    return w, float(y - w @ mean)


def solve(states: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """states with weights and intercept."""
    schema = T.StructType([*[f for f in states.schema.fields if f.name not in ("weights", "intercept")], T.StructField("weights", T.ArrayType(T.DoubleType())), T.StructField("intercept", T.DoubleType())])

    def run(batches):
        for pdf in batches:
            got = [solve_ridge(r.n, r.sum_y, np.asarray(r.sum_z, float), np.asarray(r.sum_zy, float), np.asarray(r.sum_zz, float), alpha) for r in pdf.itertuples()]
            yield pdf.assign(weights=[w.tolist() for w, _ in got], intercept=[b for _, b in got])

    return states.drop("weights", "intercept").mapInPandas(run, schema)


def fit_ridge(train: DataFrame, keys: list[str], features: tuple[str, ...] = FEATURES, target: str = "target", alpha: float = ALPHA) -> DataFrame:
    """A model row for each group: preprocessing, state, weights, intercept."""
    prepared = fit_preprocessing(train, keys, features)
    state = gram(standardise(train, prepared, keys, features), keys, len(features), target)
    return solve(prepared.join(state, keys), alpha)


def update_ridge(models: DataFrame, new: DataFrame, keys: list[str], features: tuple[str, ...] = FEATURES, target: str = "target", alpha: float = ALPHA) -> DataFrame:
    """Models with the sums of new pairs added and solved again; preprocessing
    stays frozen. Groups without new pairs keep their sums."""
    add = gram(standardise(new, models, keys, features), keys, len(features), target)
    add = add.select(*keys, *[F.col(c).alias(f"__{c}") for c in ("n", "sum_y", "sum_z", "sum_zy", "sum_zz")])
    out = models.join(add, keys, "left").withColumns({c: F.col(c) + F.coalesce(F.col(f"__{c}"), F.lit(0)) for c in ("n", "sum_y")})
    out = out.withColumns({c: F.when(F.col(f"__{c}").isNull(), F.col(c)).otherwise(F.zip_with(c, f"__{c}", lambda a, b: a + b)) for c in ("sum_z", "sum_zy", "sum_zz")})
    return solve(out.select(*models.columns), alpha)


def predict_ridge(df: DataFrame, models: DataFrame, keys: list[str], features: tuple[str, ...] = FEATURES) -> DataFrame:
    """df with `predicted`, within [0, 100]."""
    out = standardise(df, models, keys, features).join(models.select(*keys, "weights", "intercept"), keys)
    raw = F.col("intercept") + F.aggregate(F.zip_with("z", "weights", lambda z, w: z * w), F.lit(0.0), lambda a, x: a + x)
    return out.withColumn("predicted", clipped(raw)).drop("z", "weights", "intercept")


def contributions(df: DataFrame, models: DataFrame, keys: list[str], features: tuple[str, ...] = FEATURES) -> DataFrame:
    """(keys, cycle_id, feature, contribution): weight times standardised value."""
    out = standardise(df, models, keys, features).join(models.select(*keys, "weights"), keys)
    rows = F.arrays_zip(F.array(*[F.lit(f) for f in features]).alias("feature"), F.zip_with("z", "weights", lambda z, w: z * w).alias("contribution"))
    return out.select(*keys, "cycle_id", F.explode(rows).alias("x")).select(*keys, "cycle_id", F.col("x.feature"), F.col("x.contribution"))


# ---------------------------------------------------------------- folds
def _fold_solution(sums: np.ndarray, centre: np.ndarray, medians: np.ndarray, alpha: float, frozen: tuple[np.ndarray, np.ndarray, np.ndarray] | None):
    """(n, medians, means, scales, weights, intercept) of one fold from its sums
    of products (folds.running_products); frozen: medians, means and scales."""
    d = len(medians)
    g = np.zeros((2 * d + 2, 2 * d + 2))
    g[np.triu_indices(2 * d + 2)] = sums
    g = g + np.triu(g, 1).T
    n, fill = g[-1, -1], (frozen[0] if frozen else medians) - centre[:d]
    # a filled value is the value plus, where it is missing, the median
    into = np.vstack([np.eye(d), np.diag(fill)])
    total, y = into.T @ g[: 2 * d, -1], g[-2, -1]
    ff = into.T @ g[: 2 * d, : 2 * d] @ into - np.outer(total, total) / n
    fy = into.T @ g[: 2 * d, -2] - total * y / n
    means = total / n + centre[:d]
    if frozen:
        medians, mean, scale = frozen
    else:
        spread = np.maximum(np.diag(ff) / n, 0)
        spread[spread <= 1e-12 * (spread + (total / n) ** 2)] = 0  # what rounding leaves of a constant
        mean, scale = means, np.where(spread > 0, np.sqrt(spread), 1.0)
    w = np.linalg.solve(ff / np.outer(scale, scale) + alpha * np.eye(d), fy / scale)
    return int(round(n)), medians, mean, scale, w, float(y / n + centre[d] - w @ ((means - mean) / scale))


def fold_models(rows: DataFrame, features: tuple[str, ...] = FEATURES, alpha: float = ALPHA, frozen: bool = False) -> DataFrame:
    """A ridge model of every user's every fold (user_id, fold, n, medians, means,
    scales, weights, intercept) from folds.fold_rows. frozen: preprocessing stays
    as the first fold has it. Sums and medians run over the blocks; what is left
    for each fold is a solve of as many unknowns as features."""
    middle = running_medians(rows, features)
    joined = running_products(rows, features).join(middle, ["user_id", "fold"])
    schema = T.StructType([rows.schema["user_id"], T.StructField("fold", T.IntegerType()), T.StructField("n", T.LongType()), *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("medians", "means", "scales", "weights")], T.StructField("intercept", T.DoubleType())])

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                first = None
                if frozen:
                    _, *first, _, _ = _fold_solution(np.asarray(r.sums0, float), np.asarray(r.centre, float), np.asarray(r.medians0, float), alpha, None)
                got = _fold_solution(np.asarray(r.sums, float), np.asarray(r.centre, float), np.asarray(r.medians, float), alpha, tuple(first) if first else None)
                out.append((r.user_id, r.fold, *[x.tolist() if isinstance(x, np.ndarray) else x for x in got]))
            yield pd.DataFrame(out, columns=schema.names)

    if frozen:
        first = joined.where("fold = 0").select("user_id", F.col("sums").alias("sums0"), F.col("medians").alias("medians0"))
        joined = joined.join(first, "user_id")
    return joined.mapInPandas(run, schema)


def sliding_forecasts(pairs: DataFrame, features: tuple[str, ...] = FEATURES, days: int = 90, least: int = 30, alpha: float = ALPHA) -> DataFrame:
    """pairs with `predicted` by a ridge of their own, trained on the user's pairs
    of the last `days` days; those with fewer than `least` have no row. What is
    missing counts as the window's mean."""
    schema = T.StructType([*pairs.select("user_id", "cycle_id").schema.fields, T.StructField("n", T.LongType()), *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("medians", "means", "scales", "weights")], T.StructField("intercept", T.DoubleType())])
    d = len(features)
    triangle = {ij: at for at, ij in enumerate((i, j) for i in range(2 * d + 2) for j in range(i, 2 * d + 2))}

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                sums, centre = np.asarray(r.sums, float), np.asarray(r.centre, float)
                n = sums[-1]
                have = n - np.array([sums[triangle[d + i, 2 * d + 1]] for i in range(d)])
                means = np.array([sums[triangle[i, 2 * d + 1]] for i in range(d)]) / np.maximum(have, 1) + centre[:d]
                got = _fold_solution(sums, centre, means, alpha, None)
                out.append((r.user_id, r.cycle_id, *[x.tolist() if isinstance(x, np.ndarray) else x for x in got]))
            yield pd.DataFrame(out, columns=schema.names)

    enough = sliding_products(pairs, features, days).where(F.round(F.element_at("sums", -1)) >= least)
    return predict_ridge(pairs, enough.mapInPandas(run, schema), ["user_id", "cycle_id"], features)


def _residuals(predicted: DataFrame) -> DataFrame:
    return predicted.withColumn("residual", F.col("target") - F.col("predicted"))


def validate_ridge(rows: DataFrame, features: tuple[str, ...] = FEATURES, alpha: float = ALPHA) -> DataFrame:
    """Test rows of walk-forward folds (folds.fold_rows) with `predicted` and
    `residual` (actual - predicted); every user's folds are fitted in one job."""
    return _residuals(predict_ridge(test_rows(rows), fold_models(rows, features, alpha), ["user_id", "fold"], features))


def validate_incremental(rows: DataFrame, features: tuple[str, ...] = FEATURES, alpha: float = ALPHA) -> DataFrame:
    """The same by the incremental learner: preprocessing stays as the first
    fold's training rows have it, and later folds add to its sums."""
    return _residuals(predict_ridge(test_rows(rows), fold_models(rows, features, alpha, frozen=True), ["user_id", "fold"], features))


def _newton(sums: DataFrame, c: float) -> DataFrame:
    """One Newton step of every fold: weights (the intercept last, not penalised)
    and the length of the step."""
    schema = T.StructType([*sums.select("user_id", "fold").schema.fields, T.StructField("weights", T.ArrayType(T.DoubleType())), T.StructField("step", T.DoubleType())])

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                w = np.asarray(r.weights, float)
                size = len(w)
                h = np.zeros((size, size))
                h[np.triu_indices(size)] = np.asarray(r.hessian, float)
                h = h + np.triu(h, 1).T
                penalty = np.append(np.full(size - 1, 1 / c), 1e-9)
                step = np.linalg.solve(h + np.diag(penalty), np.asarray(r.gradient, float) + penalty * w)
                out.append((r.user_id, r.fold, (w - step).tolist(), float(np.abs(step).max())))
            yield pd.DataFrame(out, columns=schema.names)

    return sums.mapInPandas(run, schema)


def fold_classifiers(rows: DataFrame, features: tuple[str, ...] = FEATURES, c: float = 1.0, tolerance: float = 1e-9, rounds: int = 50) -> DataFrame:
    """A class-balanced logistic regression of every user's every fold whose
    training rows hold both classes: user_id, fold, medians, means, scales and
    weights, the intercept last.

    Each round is one job: a row meets the models of the folds that train on it
    where it is read, and their sums of weighted products are added up there, so
    that no row is shuffled twice. Folds that have settled take no further part."""
    d = len(features)
    prepared = fold_models(rows, features).select("user_id", "fold", "medians", "means", "scales")
    counts = training(rows, positive=("sum", F.col("low_recovery")), all=("count", F.lit(1))).where("positive > 0 and positive < all")
    base = materialise(prepared.join(counts, ["user_id", "fold"]).withColumns({"share1": F.col("all") / (2.0 * F.col("positive")), "share0": F.col("all") / (2.0 * (F.col("all") - F.col("positive")))}).drop("positive", "all"), "classifiers")
    narrow = materialise(rows.where("block is not null").select("user_id", "block", "low_recovery", F.array(*values(features)).alias("x")).repartition("user_id"), "labelled")
    state = base.select("user_id", "fold", F.array_repeat(F.lit(0.0), d + 1).alias("weights"))
    done = None
    for _ in range(rounds):
        models = base.join(state, ["user_id", "fold"])
        met = narrow.join(models.withColumnRenamed("user_id", "u"), (F.col("user_id") == F.col("u")) & (F.col("block") <= F.col("fold"))).drop("u")
        z = F.concat(F.zip_with(F.zip_with("x", "medians", lambda x, m: F.coalesce(x, m)), F.zip_with("means", "scales", lambda m, s: F.struct(m.alias("m"), s.alias("s"))), lambda x, p: (x - p["m"]) / p["s"]), F.array(F.lit(1.0)))
        met = met.select("user_id", "fold", "low_recovery", "weights", F.when(F.col("low_recovery") == 1, F.col("share1")).otherwise(F.col("share0")).alias("share"), z.alias("z"))
        score = F.aggregate(F.zip_with("z", "weights", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        met = met.withColumn("p", 1 / (1 + F.exp(-score)))
        zs, pull = [F.col("z")[i] for i in range(d + 1)], F.col("share") * (F.col("p") - F.col("low_recovery"))
        bend = F.col("share") * F.col("p") * (1 - F.col("p"))
        sums = met.groupBy("user_id", "fold").agg(F.first("weights").alias("weights"), *[F.sum(pull * v).alias(f"g{i}") for i, v in enumerate(zs)], *[F.sum(bend * zs[i] * zs[j]).alias(f"h{i}_{j}") for i in range(d + 1) for j in range(i, d + 1)])
        sums = sums.select("user_id", "fold", "weights", F.array(*[f"g{i}" for i in range(d + 1)]).alias("gradient"), F.array(*[f"h{i}_{j}" for i in range(d + 1) for j in range(i, d + 1)]).alias("hessian"))
        stepped = materialise(_newton(sums, c), "newton")
        settled = stepped.where(F.col("step") < tolerance).select("user_id", "fold", "weights")
        done = settled if done is None else done.unionByName(settled)
        state = stepped.where(F.col("step") >= tolerance).select("user_id", "fold", "weights")
        if state.isEmpty():
            break
    else:
        raise RuntimeError(f"classifiers not settled after {rounds} rounds")
    return base.select("user_id", "fold", "medians", "means", "scales").join(done, ["user_id", "fold"])


def validate_low_recovery(rows: DataFrame, features: tuple[str, ...] = FEATURES, c: float = 1.0) -> DataFrame:
    """Test rows of walk-forward folds with the `probability` of low recovery.
    Folds whose training rows hold one class have no rows; fold_status counts
    them."""
    keys = ["user_id", "fold"]
    models = fold_classifiers(rows, features, c)
    out = standardise(test_rows(rows), models, keys, features).join(models.select(*keys, "weights"), keys)
    score = F.aggregate(F.zip_with(F.concat("z", F.array(F.lit(1.0))), "weights", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return out.withColumn("probability", 1 / (1 + F.exp(-score))).drop("z", "weights")


def _filled(x: np.ndarray, train: np.ndarray) -> np.ndarray:
    """x for every fold (folds, rows, features), what is not finite as the median
    of the fold's training rows; 0 where they have none."""
    x = np.where(np.isfinite(x), x, np.nan)
    out = np.repeat(x[None], len(train), 0)
    for j in np.flatnonzero(np.isnan(x).any(0)):
        for k, own in enumerate(train):
            known = x[own, j][~np.isnan(x[own, j])]
            out[k, np.isnan(x[:, j]), j] = np.median(known) if len(known) else 0.0
    return out


def boosted_forecasts(x: np.ndarray, y: np.ndarray, train: np.ndarray, trees: int, depth: int, step: float) -> np.ndarray:
    """Forecasts (folds, rows) of all rows by boosted regression trees of each
    fold. x is (folds, rows, features) and train says which rows a fold learns
    from. The trees of all folds grow together: along a feature's sorted values,
    running sums of errors and counts give the gain of every cut."""
    folds, n, d = x.shape
    each, row = np.arange(folds), np.arange(n)[None]
    at = each[:, None]
    orders = [np.argsort(np.where(train, x[:, :, j], np.inf), 1, kind="stable") for j in range(d)]
    along = [x[at, o, j] for j, o in enumerate(orders)]
    fit = np.repeat((np.where(train, y, 0).sum(1) / train.sum(1))[:, None], n, 1)

    def cuts(rows: np.ndarray, error: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best (feature, cut) of each fold among `rows`; feature -1 for none."""
        best, feature, cut = np.full(folds, 1e-12), np.full(folds, -1), np.zeros(folds)
        for j, o in enumerate(orders):
            own = rows[at, o]
            total, count = np.cumsum(np.where(own, error[at, o], 0), 1), np.cumsum(own, 1)
            value = np.where(own, along[j], np.inf)
            after = np.minimum.accumulate(value[:, ::-1], 1)[:, ::-1]  # the next value of the rows
            after = np.concatenate([after[:, 1:], np.full((folds, 1), np.inf)], 1)
            rest, whole = size[:, None] - count, total[:, -1:]
            gain = total**2 / np.maximum(count, 1) + (whole - total) ** 2 / np.maximum(rest, 1) - whole**2 / np.maximum(size, 1)[:, None]
            gain = np.where(own & (after > value) & (rest > 0), gain, 0)
            p = gain.argmax(1)
            more = gain[each, p] > best * (1 + 1e-9)  # features that part the rows alike tie; the first stays
            best[more], feature[more] = gain[each, p][more], j
            cut[more] = ((value[each, p] + after[each, p]) / 2)[more]
        return feature, cut

    for _ in range(trees):
        error = np.where(train, y - fit, 0)
        node, going = np.zeros((folds, n), int), np.ones((folds, n), bool)
        for level in range(depth + 1):
            below = np.zeros((folds, n), int)
            for b in range(1 << level):
                here = going & (node == b)
                rows = here & train
                size = rows.sum(1)
                if not size.any():
                    continue
                feature, cut = cuts(rows, error, size) if level < depth else (np.full(folds, -1), np.zeros(folds))
                leaf = here & (feature < 0)[:, None]
                mean = np.where(rows, error, 0).sum(1) / np.maximum(size, 1)
                fit += np.where(leaf, step * mean[:, None], 0)
                going &= ~leaf
                right = x[at, row, np.maximum(feature, 0)[:, None]] > cut[:, None]
                below = np.where(here & ~leaf, 2 * b + right, below)
            node = below
    return fit


#: Numbers (folds x rows x features) that are worked on at a time.
BOOSTED_BLOCK = 4_000_000


def validate_boosted(rows: DataFrame, features: tuple[str, ...] = FEATURES, trees: int = 80, depth: int = 2, step: float = 0.05) -> DataFrame:
    """Test rows of walk-forward folds (user_id, fold, cycle_id, target) with
    `predicted` (within [0, 100]) by boosted trees of each fold. Rows come to a
    user's task once, and its folds grow there side by side, as many at a time
    as BOOSTED_BLOCK allows."""
    names = ["user_id", "fold", "cycle_id", "target"]
    schema = T.StructType([*rows.select(*names).schema.fields, T.StructField("predicted", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_index")
        x, y, block, fold = pdf[list(features)].to_numpy(float), pdf["target"].to_numpy(float), pdf["block"].to_numpy(float), pdf["fold"].to_numpy(float)
        every, out = np.unique(fold[fold >= 0]), []
        some = max(1, BOOSTED_BLOCK // max(1, x.size))
        for lo in range(0, len(every), some):
            ks = every[lo : lo + some]
            train = block[None] <= ks[:, None]
            got = boosted_forecasts(_filled(x, train), y, train, trees, depth, step)
            k, i = np.nonzero(fold[None] == ks[:, None])
            out.append(pdf[names].iloc[i].assign(predicted=np.clip(got[k, i], 0, 100)))
        return pd.concat(out).astype({"fold": "int32"}) if out else pdf[names].head(0).assign(predicted=pd.Series(dtype=float))

    # growing is the work here, so small tables are spread over all cores as well; a
    # plan that has them by user in one part would be left as it is, a table is not
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = rows.select(*names, "row_index", "block", *[f for f in features if f not in names])
    return materialise(narrow, "boosting").repartition(parts, "user_id").groupBy("user_id").applyInPandas(run, schema)


def suite_metrics(rows: DataFrame, features: tuple[str, ...] = FEATURES, models: tuple[str, ...] = ("persistence", "ridge", "incremental_ridge", "boosted")) -> DataFrame:
    """(user_id, model_name, fold, metric, value) of several forecasters over the
    same folds (folds.fold_rows), which are written once."""
    from .monitor import persistence_forecast
    from .supervised import metrics_long, regression_metrics

    rows = materialise(rows, "folds")
    made = {"persistence": lambda: persistence_forecast(test_rows(rows)), "ridge": lambda: validate_ridge(rows, features), "incremental_ridge": lambda: validate_incremental(rows, features), "boosted": lambda: validate_boosted(rows, features)}
    out = None
    for name in models:
        own = made[name]().select("user_id", "fold", "target", "predicted", F.lit(name).alias("model_name"))
        out = own if out is None else out.unionByName(own)
    keys = ["user_id", "model_name", "fold"]
    return metrics_long(regression_metrics(out, keys), keys)


def compare_models(rows: DataFrame, features: tuple[str, ...] = FEATURES, models: tuple[str, ...] = ("persistence", "ridge", "incremental_ridge", "boosted")) -> DataFrame:
    """(user_id, model_name, metric, mean, std, folds): suite_metrics by model."""
    from .supervised import metric_summary

    return metric_summary(suite_metrics(rows, features, models), ["user_id", "model_name"])


# ---------------------------------------------------------------- pooled models
def pooled_preprocessing(train: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """fit_preprocessing over all rows, as one row of the key __all; medians are
    found by counting, so that no task holds a column's values."""
    medians = exact_quantiles(train, list(features), [0.5])
    fill = [medians[f][0] or 0.0 for f in features]
    x = [F.coalesce(v, F.lit(m)) for v, m in zip(values(features), fill)]
    scale = lambda c: F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(F.lit(1.0))
    return train.agg(F.array(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in x]).alias("means"), F.array(*[scale(c) for c in x]).alias("scales")).select(F.lit(0).alias("__all"), F.array(*[F.lit(m) for m in fill]).alias("medians"), "means", "scales")


def _vectors(df: DataFrame, features: tuple[str, ...], prepared: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    d = standardise(df.withColumn("__all", F.lit(0)), F.broadcast(prepared), ["__all"], features)  # one row
    return d.withColumn("features", array_to_vector("z")).drop("z", "__all")


def fit_boosted(train: DataFrame, features: tuple[str, ...] = FEATURES, trees: int = 80, depth: int = 2, step: float = 0.05, seed: int = 42):
    """(model, preprocessing) of gradient-boosted trees over all users."""
    from pyspark.ml.regression import GBTRegressor

    prepared = pooled_preprocessing(train, features)
    model = GBTRegressor(labelCol="target", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed).fit(_vectors(train, features, prepared).withColumn("target", F.col("target").cast("double")))
    return model, prepared


def predict_boosted(df: DataFrame, fitted, features: tuple[str, ...] = FEATURES) -> DataFrame:
    model, prepared = fitted
    return model.transform(_vectors(df, features, prepared)).withColumn("predicted", clipped(F.col("prediction"))).drop("prediction", "features")


def fit_low_recovery(train: DataFrame, features: tuple[str, ...] = FEATURES, c: float = 1.0):
    """(model, preprocessing) of a class-balanced logistic regression."""
    from pyspark.ml.classification import LogisticRegression

    prepared = pooled_preprocessing(train, features)
    n = {r[0]: r[1] for r in train.groupBy("low_recovery").count().collect()}
    if len(n) < 2:
        raise ValueError("both classes are needed")
    total = sum(n.values())
    weight = F.when(F.col("low_recovery") == 1, total / (2.0 * n[1])).otherwise(total / (2.0 * n[0]))
    rows = _vectors(train, features, prepared).withColumns({"label": F.col("low_recovery").cast("double"), "weight": weight})
    model = LogisticRegression(weightCol="weight", regParam=1.0 / (c * total), standardization=False, maxIter=200, tol=1e-10).fit(rows)
    return model, prepared


def predict_low_recovery(df: DataFrame, fitted, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """df with `probability` of low recovery."""
    from pyspark.ml.functions import vector_to_array

    model, prepared = fitted
    out = model.transform(_vectors(df, features, prepared))
    return out.withColumn("probability", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction")
