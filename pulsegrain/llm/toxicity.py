"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A token's input is a word vector (for words of the training sample) beside the
mean vector of its hashed character trigrams. Texts are scored in overlapping
windows of tokens, forwards and backwards; attention pools the states of a
window, and a text's score is that of its worst window. Everything is numpy:
training on the driver over a bounded sample, scoring in Spark's tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .labelled import training_texts

WINDOW, STRIDE = 32, 16
CHARS = 4096

#: Tokens: runs of ASCII letters and digits and of any other alphabet's bytes.
_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = False
_BREAK[128:] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


@dataclass
class ToxicityModel:
    words: C.HashIndex
    p: dict[str, np.ndarray] = field(default_factory=dict)


class _Tokens:
    """Tokens of a slice: the distinct ones, and which each token is."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        buf = _FOLD[buf]
        starts, ends, self.first = C.word_bounds(buf, offs, _BREAK)
        h = C.span_hashes(buf, starts, ends)
        self.hash, at, self.which = np.unique(h, return_index=True, return_inverse=True)
        starts, ends = starts[at], ends[at]
        # trigrams of <token>, as bytes with a mark at either end
        size = (ends - starts + 2).astype(np.int64)
        edge = np.cumsum(size) - size
        chars = np.full(int(size.sum()), 1, np.uint32)
        inner = np.arange(len(chars)) - np.repeat(edge, size)
        body = (inner > 0) & (inner < np.repeat(size, size) - 1)
        chars[body] = buf[(np.repeat(starts, size) + inner - 1)[body]]
        code = (chars[:-2] << np.uint32(16)) | (chars[1:-1] << np.uint32(8)) | chars[2:] if len(chars) > 2 else np.zeros(0, np.uint32)
        ok = inner[: len(code)] < np.repeat(size, size)[: len(code)] - 2
        self.tri = ((code * np.uint32(2654435761)) >> np.uint32(20))[ok].astype(np.int64)
        self.tri_n = size - 2
        self.tri_at = np.cumsum(self.tri_n) - self.tri_n

    def mean(self, table: np.ndarray) -> np.ndarray:
        if not len(self.tri):
            return np.zeros((0, table.shape[1]), table.dtype)
        return np.add.reduceat(table[self.tri], self.tri_at, axis=0) / self.tri_n[:, None].astype(table.dtype)


def _windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token, tokens, text) of every window: each text's tokens at a
    stride, the last window flush with the end."""
    n = np.diff(first)
    many = np.where(n > WINDOW, (n - WINDOW + STRIDE - 1) // STRIDE + 1, (n > 0).astype(np.int64))
    text = np.repeat(np.arange(len(n)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    start = np.minimum(nth * STRIDE, np.maximum(n[text] - WINDOW, 0))
    return first[:-1][text] + start, np.minimum(n[text], WINDOW), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _run(gx: np.ndarray, mask: np.ndarray | None, u: np.ndarray, reverse: bool, keep: bool = False):
    """States (T, B, H) of one direction from its input gates (T, B, 3H); keep:
    also what the backward pass needs."""
    steps, batch, three = gx.shape
    size = three // 3
    h = np.zeros((batch, size), gx.dtype)
    out = np.empty((steps, batch, size), gx.dtype)
    tape = {}
    for t in reversed(range(steps)) if reverse else range(steps):
        gh = h @ u
        rz = _sigmoid(gx[t][:, : 2 * size] + gh[:, : 2 * size])
        r, z = rz[:, :size], rz[:, size:]
        n = np.tanh(gx[t][:, 2 * size :] + r * gh[:, 2 * size :])
        new = n + z * (h - n)
        if mask is not None:
            new = new * mask[t][:, None] + h * (1 - mask[t][:, None])
        if keep:
            tape[t] = (h, r, z, n, gh[:, 2 * size :])
        h = new
        out[t] = h
    return (out, tape) if keep else out


def _back(dout: np.ndarray, tape: dict, mask: np.ndarray, u: np.ndarray, reverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input gates and of u."""
    steps, batch, size = dout.shape
    dgx = np.zeros((steps, batch, 3 * size), dout.dtype)
    du, dh = np.zeros_like(u), np.zeros((batch, size), dout.dtype)
    for t in range(steps) if reverse else reversed(range(steps)):
        h, r, z, n, ghn = tape[t]
        m = mask[t][:, None]
        d = dh + dout[t]
        dn_ = d * m
        dz = dn_ * (h - n) * z * (1 - z)
        dn = dn_ * (1 - z) * (1 - n * n)
        dr = dn * ghn * r * (1 - r)
        dgh = np.concatenate([dr, dz, dn * r], 1)
        dgx[t] = np.concatenate([dr, dz, dn], 1)
        du += h.T @ dgh
        dh = dn_ * z + d * (1 - m) + dgh @ u.T
    return dgx, du


def _logits(p: dict, gates: np.ndarray, which: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Logit of every window; gates: input gates of each distinct token, both
    directions side by side."""
    h = p["uf"].shape[0]
    out = np.empty(len(start), np.float32)
    for lo in range(0, len(start), 8192):
        s, n = start[lo : lo + 8192], size[lo : lo + 8192]
        steps = int(n.max())
        at = np.minimum(np.arange(steps)[:, None], n[None, :] - 1) + s[None, :]
        full = bool((n == steps).all())
        mask = None if full else (np.arange(steps)[:, None] < n[None, :]).astype(np.float32)
        gx = gates[which[at]]
        states = np.concatenate([_run(gx[:, :, : 3 * h], mask, p["uf"], False), _run(gx[:, :, 3 * h :], mask, p["ub"], True)], 2)
        e = states @ p["v"]
        if mask is not None:
            e = np.where(mask > 0, e, -1e9)
        e = np.exp(e - e.max(0))
        pooled = np.einsum("tb,tbh->bh", e / e.sum(0), states)
        out[lo : lo + 8192] = pooled @ p["w"] + p["b"][0]
    return out


def _gates(model: ToxicityModel, tokens: _Tokens) -> np.ndarray:
    p = model.p
    at = model.words.find(tokens.hash)
    word = p["words"][model.words.values[0][at] if len(model.words.keys) else np.zeros(len(at), int)]
    x = np.concatenate([np.where(at[:, None] >= 0, word, 0), tokens.mean(p["chars"])], 1)
    return x @ p["wx"] + p["bx"]


def score_slice(buf: np.ndarray, offs: np.ndarray, model: ToxicityModel | None) -> np.ndarray:
    """Score of each text: its highest window's probability; 0 without tokens."""
    out = np.zeros(len(offs) - 1)
    if model is None:
        return out
    tokens = _Tokens(buf, offs)
    start, size, text = _windows(tokens.first)
    if len(start):
        logits = _logits(model.p, _gates(model, tokens), tokens.which, start, size)
        head = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        out[text[head]] = _sigmoid(np.maximum.reduceat(logits, head).astype(np.float64))
    return out


def fit(rows: list[tuple[str, int]], hidden: int = 8, dim: int = 8, steps: int = 500, seed: int = 5, rate: float = 0.01, doubt: float = 0.5, jitter: int = 12, drop: float = 0.3) -> ToxicityModel | None:
    """Train on (text, label). A labelled text is a bag of windows: a toxic one
    is represented by its most suspicious window (by the words' log odds over
    the sample, for the first sixth of the epochs, then by the network), a clean
    one by its most suspicious and a random window. There are as many epochs, 12
    at least, as give `steps` batches of 64, so that a small sample is seen more
    often; a window moves by up to `jitter` tokens each time and a word shows its
    characters alone with the chance `drop`, so that none is learnt by heart.
    Labels may be wrong: after that sixth a window counts by the probability of
    its label to the power of `doubt`, so that no share of them is left out."""
    if not rows or len({y for _, y in rows}) < 2:
        return None
    rng = np.random.default_rng(seed)
    _, _, buf, offs = next(C.text_slices(pa.array([t for t, _ in rows]), 1 << 40))
    y = np.array([v for _, v in rows])
    tokens = _Tokens(buf, offs)
    doc = np.repeat(np.arange(len(rows)), np.diff(tokens.first))
    pairs = np.unique(doc * len(tokens.hash) + tokens.which)
    d, w = pairs // len(tokens.hash), pairs % len(tokens.hash)
    with_y = [np.bincount(w[y[d] == v], minlength=len(tokens.hash)) for v in (0, 1)]
    odds = np.log((with_y[1] + 0.5) / (y.sum() + 1)) - np.log((with_y[0] + 0.5) / ((1 - y).sum() + 1))
    known = np.flatnonzero(with_y[0] + with_y[1] >= 5)
    model = ToxicityModel(C.HashIndex(tokens.hash[known], np.arange(len(known))))
    f4 = lambda *s, k=0.3: (rng.standard_normal(s) * k).astype(np.float32)
    p = model.p
    # a word vector begins as the word's log odds, so that a few toxic texts do
    p["words"], p["chars"] = f4(len(known) + 1, dim, k=0.05), f4(CHARS, dim, k=0.1)
    p["words"][: len(known), 0] = np.clip(odds[known], -3, 3) / 3
    p["wx"], p["bx"] = f4(2 * dim, 6 * hidden), np.zeros(6 * hidden, np.float32)
    p["uf"], p["ub"] = f4(hidden, 3 * hidden), f4(hidden, 3 * hidden)
    p["v"], p["w"], p["b"] = f4(2 * hidden), f4(2 * hidden), np.zeros(1, np.float32)
    word_row = np.full(len(tokens.hash), -1, np.int64)
    at = model.words.find(tokens.hash)
    word_row[at >= 0] = model.words.values[0][at[at >= 0]]

    start, size, text = _windows(tokens.first)
    # words of few texts say little, whatever their odds
    weight = np.where(word_row >= 0, np.maximum(odds, 0), 0)[tokens.which]
    total = np.concatenate([[0], np.cumsum(weight * weight)])
    suspicion = total[start + size] - total[start]
    adam = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    epochs = max(12, -(-steps * 64 // max(1, int(((y == 1) + 2 * (y == 0))[np.unique(text)].sum()))))
    for epoch in range(epochs):
        if epoch >= epochs // 6:
            suspicion = _logits(p, _gates(model, tokens), tokens.which, start, size)
        order = np.lexsort((-suspicion, text))
        worst = order[np.append(True, text[order][1:] != text[order][:-1])]
        lots = rng.permutation(len(start))
        order = lots[np.argsort(text[lots], kind="stable")]
        other = order[np.append(True, text[order][1:] != text[order][:-1])]
        chosen = np.concatenate([worst, other[y[text[other]] == 0]])
        chosen = rng.permutation(chosen)
        for lo in range(0, len(chosen), 64):
            c = chosen[lo : lo + 64]
            n, target = size[c], y[text[c]].astype(np.float32)
            long = int(n.max())
            # each time a little to the left or right, so that windows are not learnt by heart
            begin = np.clip(start[c] + rng.integers(-jitter, jitter + 1, len(c)), tokens.first[text[c]], tokens.first[text[c] + 1] - n)
            idx = np.minimum(np.arange(long)[:, None], n[None] - 1) + begin[None]
            mask = (np.arange(long)[:, None] < n[None]).astype(np.float32)
            which = tokens.which[idx]  # tokens, batch
            uniq, inv = np.unique(which, return_inverse=True)
            inv = inv.reshape(which.shape)
            tri_n = tokens.tri_n[uniq]
            tri = tokens.tri[np.repeat(tokens.tri_at[uniq], tri_n) + np.arange(tri_n.sum()) - np.repeat(np.cumsum(tri_n) - tri_n, tri_n)]
            owner = np.repeat(np.arange(len(uniq)), tri_n)
            mean = np.add.reduceat(p["chars"][tri], np.cumsum(tri_n) - tri_n, axis=0) / tri_n[:, None].astype(np.float32)
            rows_w = word_row[uniq]
            hidden_words = rng.random(len(uniq)) < drop  # so that characters are learnt beside words
            seen = (rows_w >= 0) & ~hidden_words
            x = np.concatenate([np.where(seen[:, None], p["words"][rows_w], 0), mean], 1)
            g = (x @ p["wx"] + p["bx"])[inv]
            hf, tf = _run(g[:, :, : 3 * hidden], mask, p["uf"], False, True)
            hb, tb = _run(g[:, :, 3 * hidden :], mask, p["ub"], True, True)
            s = np.concatenate([hf, hb], 2)
            e = np.where(mask > 0, s @ p["v"], -1e9)
            a = np.exp(e - e.max(0))
            a /= a.sum(0)
            pooled = np.einsum("tb,tbh->bh", a, s)
            miss = _sigmoid(pooled @ p["w"] + p["b"][0]) - target
            trust = (1 - np.abs(miss)) ** doubt if epoch >= epochs // 6 else 1.0
            dz = (miss * trust / len(c)).astype(np.float32)
            grad = {"w": pooled.T @ dz, "b": np.array([dz.sum()], np.float32)}
            dpool = dz[:, None] * p["w"][None]
            da = np.einsum("bh,tbh->tb", dpool, s)
            de = a * (da - (a * da).sum(0))
            grad["v"] = np.einsum("tb,tbh->h", de, s)
            ds = a[:, :, None] * dpool[None] + de[:, :, None] * p["v"]
            gf, grad["uf"] = _back(ds[:, :, :hidden], tf, mask, p["uf"], False)
            gb, grad["ub"] = _back(ds[:, :, hidden:], tb, mask, p["ub"], True)
            dg = np.zeros((len(uniq), 6 * hidden), np.float32)
            np.add.at(dg, inv.ravel(), np.concatenate([gf, gb], 2).reshape(-1, 6 * hidden))
            grad["wx"], grad["bx"] = x.T @ dg, dg.sum(0)
            dx = dg @ p["wx"].T
            grad["words"], grad["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
            np.add.at(grad["words"], rows_w[seen], dx[seen, :dim])
            np.add.at(grad["chars"], tri, (dx[:, dim:] / tri_n[:, None])[owner])
            step += 1
            for k, gr in grad.items():
                m, v = adam[k]
                m += 0.1 * (gr - m)
                v += 0.001 * (gr * gr - v)
                p[k] -= (rate * (1 - 0.9 * epoch / epochs) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 1200, threshold: float = 0.7, score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """docs with score_col and predicted_col appended (other columns stay;
    columns of those names give way).

    Labels are learnt from at most per_class rows of either label that `train`
    (on the labels table) allows. Every window of the whole text is scored and
    the highest counts. Null and empty texts, and any text if nothing can be
    learnt, score 0. One row for each input row: repeated rows are scored alike,
    a null id is scored like any other, an empty table stays empty. A text of
    any length is scored whole by one task, window by window.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(training_texts(docs, labels, label_col, train, per_class, id_col, text_col)))
    source = docs.drop(score_col, predicted_col)
    schema = T.StructType([*source.schema.fields, T.StructField(score_col, T.DoubleType())])
    names, at = source.columns, source.columns.index(text_col)

    def run(batches):
        for b in batches:
            for lo, hi, buf, offs in C.text_slices(b.column(at)):
                part = b.slice(lo, hi - lo)
                yield C.arrow_rows(schema, **{n: part.column(i) for i, n in enumerate(names)}, **{score_col: score_slice(buf, offs, model.value)})

    return source.mapInArrow(C.tidy(run), schema).withColumn(predicted_col, (F.col(score_col) >= threshold).cast("int"))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels whose id's crc32 mod 3 is not 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = C.crc_bucket("doc_id", 3) == 1
    out = score_toxicity(docs, labels, ~held)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")
