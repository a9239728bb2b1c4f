"""Quality by a sparse rule ensemble.

Small trees are boosted over text statistics of a bounded labelled sample;
every path from a root becomes a conjunctive rule; lasso logistic regression
keeps few of them; and the rules that stay are compiled into one Spark column
expression over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .labelled import training_rows
from .text_stats import FEATURES, quality_features

#: A condition: (feature, at most?, threshold).
Rule = tuple[tuple[str, bool, float], ...]


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)


def _matches(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = None
    for name, at_most, cut in rule:
        c = x[name] <= cut if at_most else x[name] > cut
        out = c if out is None else out & c
    return out


def _split(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, least: int) -> tuple[int, float] | None:
    """Best (feature, threshold) for a Newton step, None if nothing is gained."""
    base = grad.sum() ** 2 / (hess.sum() + 1.0)
    best, found = base + 1e-6, None
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        v, g, h = x[order, j], np.cumsum(grad[order]), np.cumsum(hess[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        cut = cut[(cut + 1 >= least) & (len(v) - cut - 1 >= least)]
        if not len(cut):
            continue
        gain = g[cut] ** 2 / (h[cut] + 1.0) + (g[-1] - g[cut]) ** 2 / (h[-1] - h[cut] + 1.0)
        k = int(gain.argmax())
        if gain[k] > best:
            best, found = gain[k], (j, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return found


def _grow(x, grad, hess, rows, depth, least, path, rules, step):
    """Grow one tree; add every path to `rules`; `step` takes the leaf values."""
    if path:
        rules.append(tuple(path))
    found = _split(x[rows], grad[rows], hess[rows], least) if depth else None
    if found is None:
        step[rows] = -grad[rows].sum() / (hess[rows].sum() + 1.0)
        return
    j, cut = found
    low = x[rows, j] <= cut
    for at_most, part in ((True, rows[low]), (False, rows[~low])):
        _grow(x, grad, hess, part, depth - 1, least, [*path, (FEATURES[j], at_most, cut)], rules, step)


def fit_texts(rows: list[tuple[str, int]], **options) -> RuleModel:
    """fit on the statistics of (text, label) pairs."""
    parts = [quality_features(buf, offs) for _, _, buf, offs in C.text_slices(pa.array([t for t, _ in rows], pa.string()))]
    x = np.concatenate([np.zeros((0, len(FEATURES))), *[np.stack([f[n] for n in FEATURES], 1) for f in parts]])
    return fit(x, np.array([v for _, v in rows], float), **options)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 0.004, least: int = 8, seed: int = 3) -> RuleModel:
    """Train on statistics (rows x FEATURES) and labels. Without both labels the
    model is its base rate."""
    if not len(y) or y.min() == y.max():
        return RuleModel(0.0 if not len(y) else (4.0 if y[0] else -4.0))
    rng, rules = np.random.default_rng(seed), []
    score = np.zeros(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        rows_ = np.sort(rng.choice(len(y), max(2 * least, len(y) // 2), replace=len(y) < 4 * least))
        step = np.zeros(len(y))
        mine: list[Rule] = []
        _grow(x, p - y, p * (1 - p), rows_, depth, least, [], mine, step)
        # rows outside the subsample take their leaf's value by its path
        rest = np.setdiff1d(np.arange(len(y)), rows_)
        leaves = [r for r in mine if not any(o[: len(r)] == r and len(o) > len(r) for o in mine)]
        for r in leaves:
            own = _matches(r, {n: x[:, i] for i, n in enumerate(FEATURES)})
            inside = rows_[own[rows_]]
            if len(inside):
                step[rest[own[rest]]] = step[inside[0]]
        score += 0.2 * step
        rules += mine
    named = {n: x[:, i] for i, n in enumerate(FEATURES)}
    unique: dict[bytes, Rule] = {}
    for r in sorted(set(rules), key=lambda r: (len(r), r)):
        m = _matches(r, named)
        if 0 < m.sum() < len(y):
            unique.setdefault(min(m.tobytes(), (~m).tobytes()), r)
    rules = list(unique.values())
    if not rules:
        return RuleModel(float(np.log(y.mean() / (1 - y.mean()))))
    z = np.stack([_matches(r, named) for r in rules], 1).astype(float)
    # lasso logistic regression by accelerated proximal gradient
    w, b, mom_w, mom_b, t = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1]), 0.0, 1.0
    rate = 4.0 * len(y) / (np.linalg.norm(np.c_[z, np.ones(len(y))], 2) ** 2)
    for _ in range(1500):
        g = (1 / (1 + np.exp(-(z @ mom_w + mom_b))) - y) / len(y)
        new = mom_w - rate * (z.T @ g)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_b = mom_b - rate * g.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        mom_w, mom_b = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    return RuleModel(float(b), [(r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6])


def compile_rules(model: RuleModel) -> Column:
    """The model as a Spark expression over columns named as in FEATURES."""
    total = F.lit(model.intercept)
    for rule, weight in model.rules:
        cond = None
        for name, at_most, cut in rule:
            c = F.col(name) <= cut if at_most else F.col(name) > cut
            cond = c if cond is None else cond & c
        total = total + F.when(cond, F.lit(weight)).otherwise(F.lit(0.0))
    return 1.0 / (1.0 + F.exp(-total))


def text_features(docs: DataFrame, id_col: str, text_col: str, also: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns `also` and those in FEATURES of every row."""
    schema = T.StructType([*docs.select(id_col, *also).schema.fields, *[T.StructField(n, T.DoubleType()) for n in FEATURES]])

    def run(batches):
        for b in batches:
            for lo, hi, buf, offs in C.text_slices(b.column(1)):
                own = {n: b.column(i).slice(lo, hi - lo) for n, i in ((id_col, 0), *zip(also, range(2, 2 + len(also))))}
                yield C.arrow_rows(schema, **own, **quality_features(buf, offs))

    return docs.select(id_col, text_col, *also).mapInArrow(C.tidy(run), schema)


def score_quality(docs: DataFrame, labels: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = 1500, threshold: float = 0.5) -> DataFrame:
    """id, score and predicted of every row of docs.

    Labels are learnt from at most per_class rows of either label that `train`
    (on the labels table) allows; their statistics, not their texts, come to the
    driver. Null texts are empty; empty texts are scored by their statistics,
    which are all zero. Without labels the score is 0.5. One row for each input
    row: repeated rows are scored alike, a null id stays null and is not learnt
    from. Other columns play no part, whatever their names; an empty table gives
    an empty result. A text is read whole by one task.
    """
    rows = training_rows(docs, labels, label_col, train, per_class, id_col, text_col)
    rows = text_features(rows, id_col, text_col, ("y",)).orderBy(F.xxhash64(F.col(id_col)), id_col).toArrow()
    model = fit(np.stack([rows.column(n).to_numpy() for n in FEATURES], 1), rows.column("y").to_numpy().astype(float))
    out = text_features(docs, id_col, text_col).select(id_col, compile_rules(model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels whose id's crc32 mod 3 is not 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = C.crc_bucket("doc_id", 3) == 1
    out = score_quality(docs, labels, ~held)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")
