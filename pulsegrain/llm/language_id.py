"""Language identification by string kernels.

Texts are compared by a blended-spectrum presence kernel: k(x, y) counts the
n-grams (n = 1..3, over lower-cased UTF-8 bytes with every ASCII non-letter
read as a blank) that both texts hold, over the root of the two counts.
Nystrom landmarks reduce it to a few columns, one-versus-rest kernel ridge
regression gives each language a weight for each landmark, and texts are
scored in batches by two matrix products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import common as C
from .labelled import LONGEST

#: Presence features: hashed n-grams in 2**BITS places.
BITS, ORDERS = 18, (1, 2, 3)

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = True


@dataclass
class LanguageModel:
    """landmark presence (features x landmarks), their counts, weights
    (landmarks x languages), and the feature of each hashed n-gram or -1."""

    languages: list[str]
    column: np.ndarray
    landmarks: np.ndarray
    counts: np.ndarray
    weights: np.ndarray


def _grams(buf: np.ndarray, offs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place of each n-gram, its text) for each order."""
    c = _FOLD[buf]
    doc = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))
    out = []
    code = np.zeros(len(c), np.uint32)
    for n in ORDERS:
        code = c if n == 1 else (code[:-1] << np.uint32(8)) | c[n - 1 :]
        m = len(code)
        if m <= 0:
            break
        place = ((code + np.uint32(n * 0x1000193)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        inside = doc[:m] == doc[n - 1 :]
        out.append((place[inside], doc[:m][inside]))
    return out


def presence(buf: np.ndarray, offs: np.ndarray, column: np.ndarray, width: int) -> np.ndarray:
    """Texts x features: 1 where the text holds the n-gram; the last column
    counts nothing and takes n-grams that no landmark has."""
    out = np.zeros((len(offs) - 1, width + 1), np.float32)
    flat = out.ravel()
    for place, doc in _grams(buf, offs):
        flat[doc.astype(np.int64) * (width + 1) + column[place]] = 1.0
    return out[:, :width]


def _kernel(x: np.ndarray, model_landmarks: np.ndarray, counts: np.ndarray) -> np.ndarray:
    own = np.maximum(x.sum(1), 1.0)
    return (x @ model_landmarks) / np.sqrt(own[:, None] * counts[None, :])


def fit(labelled: list[tuple[str, str]], landmarks_per_language: int = 32, ridge: float = 1e-2) -> LanguageModel | None:
    """Train on (text, language) pairs; the first texts of each language are
    its landmarks. None if there is nothing to learn from."""
    rows = [(t, y) for t, y in labelled if t and y is not None]
    if not rows:
        return None
    languages = sorted({y for _, y in rows})
    seen = dict.fromkeys(languages, 0)
    chosen = []
    for i, (_, y) in enumerate(rows):
        if seen[y] < landmarks_per_language:
            seen[y] += 1
            chosen.append(i)
    place = lambda texts: next(C.text_slices(pa.array(texts), 1 << 40))[2:]
    buf, offs = place([rows[i][0] for i in chosen])
    used = np.unique(np.concatenate([p for p, _ in _grams(buf, offs)] or [np.zeros(0, np.uint32)]))
    column = np.full(1 << BITS, len(used), np.int32)
    column[used] = np.arange(len(used), dtype=np.int32)
    marks = presence(buf, offs, column, len(used))
    counts = np.maximum(marks.sum(1), 1.0)
    marks = np.ascontiguousarray(marks.T)
    k = []
    for lo in range(0, len(rows), 256):
        k.append(_kernel(presence(*place([t for t, _ in rows[lo : lo + 256]]), column, len(used)), marks, counts))
    k = np.concatenate(k).astype(np.float64)
    kmm = k[chosen]
    y = np.where(np.array([[a == b for b in languages] for _, a in rows]), 1.0, -1.0)
    # rows count so that every language weighs the same
    w = np.array([1.0 / sum(a == b for _, b in rows) for _, a in rows]) * len(rows) / len(languages)
    lhs = (k * w[:, None]).T @ k + ridge * len(rows) / 100 * kmm + 1e-6 * np.eye(len(chosen))
    weights = np.linalg.solve(lhs, (k * w[:, None]).T @ y)
    return LanguageModel(languages, column, marks, counts.astype(np.float32), weights.astype(np.float32))


def _has_letter(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(_LETTER[buf])])
    out = total[offs[1:]] > total[offs[:-1]]
    wide = np.concatenate([[0], np.cumsum(buf > 127)])
    for i in np.flatnonzero(~out & (wide[offs[1:]] > wide[offs[:-1]])):
        out[i] = any(ch.isalpha() for ch in bytes(buf[offs[i] : offs[i + 1]]).decode("utf-8", "replace"))
    return out


def predict(buf: np.ndarray, offs: np.ndarray, model: LanguageModel | None) -> tuple[list[str], np.ndarray]:
    n = len(offs) - 1
    letter = _has_letter(buf, offs)
    if model is None:
        return ["und"] * n, np.zeros(n)
    f = _kernel(presence(buf, offs, model.column, model.landmarks.shape[0]), model.landmarks, model.counts) @ model.weights
    best = f.argmax(1)
    score = (1.0 + np.clip(f[np.arange(n), best], -1.0, 1.0)) / 2.0
    return [model.languages[b] if ok else "und" for b, ok in zip(best, letter)], np.where(letter, score, 0.0)


def identify_languages(
    docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = 300, landmarks_per_language: int = 32, sample_bytes: int = 64 << 20
) -> DataFrame:
    """Language of every text.

    docs: documents; train: boolean column, the rows whose label may be learnt.
    per_language bounds the training sample (rows of each language with the
    smallest id hash, of the 1000 most frequent languages, and texts of LONGEST
    bytes at most) and landmarks_per_language the kernel's landmarks. The sample
    has sample_bytes in all, dealt evenly to the languages, and a language's
    first text whatever its length, so it fits the driver (264 MB at most).

    Returns id, lang_pred, score, one row for each input row. A null text, or
    one without a letter, is `und` with score 0; a null label is not learnt
    from; without any label everything is `und`. Repeated rows are judged alike
    and a null id stays null. Other columns are ignored, whatever their names;
    an empty table gives an empty result. A text is read whole by one task.
    """
    spark = docs.sparkSession
    docs = docs.select(id_col, text_col, label_col)
    short = docs.where(F.octet_length(text_col) <= LONGEST)
    ids = short.where(train & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col), F.col(label_col).alias("label"), F.octet_length(text_col).alias("__size"))
    picked = C.materialise(C.stratified_sample(ids, "label", F.xxhash64(F.col(id_col)), per_language), "sampled")
    share = sample_bytes // max(1, picked.select("label").distinct().count())
    first = Window.partitionBy("label").orderBy(F.xxhash64(F.col(id_col)), id_col)  # per_language rows
    picked = picked.withColumns({"__upto": F.sum("__size").over(first.rowsBetween(Window.unboundedPreceding, 0)), "__rank": F.row_number().over(first)})
    picked = picked.where((F.col("__upto") <= share) | (F.col("__rank") == 1)).select(F.col(id_col), F.col("label").alias("__label"))
    # the sample is bounded by per_language and the number of languages
    sample = short.join(F.broadcast(picked.distinct()), id_col, "inner").where(train & (F.col(label_col) == F.col("__label")))
    rows = sample.orderBy(F.xxhash64(F.col(id_col)), id_col, text_col).select(text_col, label_col).collect()
    model = spark.sparkContext.broadcast(fit([(r[0], r[1]) for r in rows], landmarks_per_language))
    schema = T.StructType([docs.schema[id_col], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def score(batches):
        m = model.value
        for b in batches:
            for lo, hi, buf, offs in C.text_slices(b.column(1)):
                for a in range(0, hi - lo, 512):
                    z = min(hi - lo, a + 512)
                    lang, s = predict(buf[offs[a] : offs[z]], offs[a : z + 1] - offs[a], m)
                    yield C.arrow_rows(schema, **{id_col: b.column(0).slice(lo + a, z - a), "lang_pred": lang, "score": s})

    return docs.select(id_col, text_col).mapInArrow(C.tidy(score), schema)


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from ids whose crc32 mod 4 is not 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = C.crc_bucket("doc_id", 4) == 2
    out = identify_languages(docs, ~held)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
