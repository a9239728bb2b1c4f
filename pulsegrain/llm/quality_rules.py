"""Quality rules: counted base rules, then n-gram perplexity bands.

A modified Kneser-Ney model of byte n-grams for each language is counted and
smoothed by Spark over every text. Its n-grams are packed into longs, so that
suffixes and contexts are shifts and masks. Texts fall into two folds by a hash
of what they say, and each fold is scored by the model of the other one, so that
neither a text nor its copies vouch for themselves. Only the n-grams that the
texts hold are scored; behind a check of their number these probabilities go out
as sorted hash arrays, and beyond it scoring is a keyed join. Documents with a
perplexity outside their language's band, up or down, are rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .text_stats import rule_counts

ORDER = 5
#: Broadcast at most this many n-grams (12 bytes each); beyond, join.
BROADCAST_GRAMS = 6_000_000
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += 32


def _packed(buf: np.ndarray, offs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of each text (lower-cased ASCII, with
    newlines before the text), and where each text's n-grams begin."""
    n_docs, pad = len(offs) - 1, order - 1
    doc = np.repeat(np.arange(n_docs), np.diff(offs))
    wide = np.full(len(buf) + n_docs * pad, 10, np.uint64)
    wide[np.arange(len(buf)) + (doc + 1) * pad] = _FOLD[buf]
    grams = np.zeros(len(wide), np.uint64)
    for j in range(order):
        grams[pad:] = (grams[pad:] << np.uint64(8)) | wide[j : len(wide) - pad + j]
    return grams[np.arange(len(buf)) + (doc + 1) * pad], doc


def _merge(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    g, c = np.concatenate(grams), np.concatenate(counts)
    order = np.argsort(g, kind="stable")
    g, c = g[order], c[order]
    head = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    return g[head], np.add.reduceat(c, head)


def fold_of(text_col: str):
    """0 or 1, by what the text says."""
    return F.pmod(F.xxhash64(F.col(text_col)), F.lit(2)).cast("int")


#: n-grams that a task holds before it passes them on.
HELD = 1_000_000


def count_grams(docs: DataFrame, text_col: str, lang_col: str, order: int = ORDER) -> DataFrame:
    """(lang, fold, gram, n) over all texts; a null lang is ''. Tasks add up
    what they read before anything is shuffled."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("fold", T.IntegerType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches):
        held: dict[tuple, tuple[list, list]] = {}
        total = 0

        def out(key):
            g, c = _merge(*held.pop(key))
            for lo in range(0, len(g), 50_000):
                part = g[lo : lo + 50_000]
                yield C.arrow_rows(schema, lang=[key[0]] * len(part), fold=[key[1]] * len(part), gram=part.view(np.int64), n=c[lo : lo + 50_000])

        for b in batches:
            for key, rows in _groups(b.column(0), b.column(1)):
                for _, _, buf, offs in C.text_slices(b.column(2).take(rows)):
                    g, _ = _packed(buf, offs, order)
                    if not len(g):
                        continue
                    g, c = np.unique(g, return_counts=True)
                    own = held.setdefault(key, ([], []))
                    own[0].append(g)
                    own[1].append(c)
                    total += len(g)
                    if total > HELD:  # of all languages together
                        held = {k: tuple([x] for x in _merge(*v)) for k, v in held.items()}
                        for k in sorted(held, key=lambda k: -len(held[k][0][0])):
                            total = sum(len(v[0][0]) for v in held.values())
                            if total <= HELD // 2:
                                break
                            yield from out(k)
        for key in list(held):
            yield from out(key)

    source = docs.select(F.col(lang_col), fold_of(text_col), F.col(text_col))
    return source.mapInArrow(C.tidy(run), schema).groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n"))


def _groups(langs: pa.Array, folds: pa.Array):
    """((lang, fold), rows) of a batch."""
    langs = langs.cast(pa.string()).fill_null("").dictionary_encode()
    codes, names = np.asarray(langs.indices) * 2 + folds.to_numpy(), langs.dictionary.to_pylist()
    for code in np.unique(codes):
        yield (names[code // 2], int(code % 2)), pa.array(np.flatnonzero(codes == code))


def crossed(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, fold, gram, logp): log2 probability of the last byte of every
    n-gram of a fold after its others, under the other fold's interpolated
    modified Kneser-Ney model. Lower orders count distinct left contexts; each
    order, language and fold has three discounts from its counts of counts. What
    the model has not seen falls back on the lower order, at last on 1/256."""
    own = ["lang", "fold"]
    other = (1 - F.col("fold")).alias("fold")
    tables = {order: C.materialise(counts, "grams")}
    for n in range(order - 1, 0, -1):
        short = F.col("gram").bitwiseAND(F.lit((1 << (8 * n)) - 1))
        tables[n] = C.materialise(tables[n + 1].groupBy(*own, short.alias("gram")).agg(F.count("*").alias("n")), "grams")
    lower = None
    for n in range(1, order + 1):
        t = tables[n]
        ones = [F.sum(F.when(F.col("n") == i, 1).otherwise(0)).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
        cc = t.groupBy(*own).agg(*ones)
        y = F.when(F.col("n1") + 2 * F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.5))
        ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.when(F.col(b) > 0, F.col(b))).otherwise(F.lit(1.0))  # noqa: E731, B023
        d = cc.select(
            *own,
            F.greatest(F.lit(0.05), F.least(F.lit(1.0), 1 - 2 * y * ratio("n2", "n1"))).alias("d1"),
            F.greatest(F.lit(0.05), F.least(F.lit(2.0), 2 - 3 * y * ratio("n3", "n2"))).alias("d2"),
            F.greatest(F.lit(0.05), F.least(F.lit(3.0), 3 - 4 * y * ratio("n4", "n3"))).alias("d3"),
        )
        off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        d = C.small(C.materialise(d, "discounts"))  # a row for each language and fold
        model = t.join(d, own).withColumn("off", F.least(off, F.col("n").cast("double")))
        contexts = model.groupBy(*own, F.shiftrightunsigned("gram", 8).alias("ctx")).agg(F.sum("n").alias("total"), F.sum("off").alias("mass"))
        seen = model.select("lang", other, "gram", (F.col("n") - F.col("off")).alias("left"))
        asked = t.select(*own, "gram", F.shiftrightunsigned("gram", 8).alias("ctx")).join(seen, [*own, "gram"], "left")
        asked = asked.join(contexts.select("lang", other, "ctx", "total", "mass"), [*own, "ctx"], "left")
        known, rest = F.coalesce(F.col("left") / F.col("total"), F.lit(0.0)), F.coalesce(F.col("mass") / F.col("total"), F.lit(1.0))
        if n == 1:
            p = asked.select(*own, "gram", (known + rest / 256).alias("p"))
        else:
            low = lower.select(*own, F.col("gram").alias("low"), F.col("p").alias("q"))
            asked = asked.withColumn("low", F.col("gram").bitwiseAND(F.lit((1 << (8 * (n - 1))) - 1)))
            p = asked.join(low, [*own, "low"]).select(*own, "gram", (known + rest * F.col("q")).alias("p"))
        lower = C.materialise(p, "probabilities")
    return lower.select(*own, "gram", F.log2("p").cast("float").alias("logp"))


def _keys(lang: str, fold: int, grams: np.ndarray) -> np.ndarray:
    salt = fold + 1
    for byte in lang.encode():
        salt = (salt * 0x100000001B3 + byte + 1) & (2**64 - 1)
    return C.mix(grams ^ C.mix(np.array([salt], np.uint64))[0])


def _arrays(model: DataFrame) -> C.HashIndex:
    """The model as hash arrays; tasks make the keys, 12 bytes an n-gram come here."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("logp", T.FloatType())])

    def run(batches):
        for b in batches:
            for key, rows in _groups(b.column(0), b.column(1)):
                grams = b.column(2).take(rows).to_numpy().view(np.uint64)
                yield C.arrow_rows(schema, key=_keys(*key, grams).view(np.int64), logp=b.column(3).take(rows))

    table = model.select("lang", "fold", "gram", "logp").mapInArrow(C.tidy(run), schema).toArrow()
    return C.HashIndex(table.column(0).to_numpy().view(np.uint64), table.column(1).to_numpy())


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _scored(docs: DataFrame, model: DataFrame, id_col: str, text_col: str, lang_col: str, order: int, broadcast_grams: int) -> DataFrame:
    """id, lang, the counts, length (bytes), and bits: mean -log2 p of the bytes."""
    spark = docs.sparkSession
    fields = [docs.schema[id_col], T.StructField("lang", T.StringType()), *[T.StructField(c, T.LongType()) for c in (*_COUNTS, "length")]]
    source = docs.select(id_col, lang_col, fold_of(text_col), text_col)
    small = model.count() <= broadcast_grams
    if small:
        index = spark.sparkContext.broadcast(_arrays(model))
        schema = T.StructType([*fields, T.StructField("bits", T.DoubleType())])
    else:
        grams = T.ArrayType(T.StructType([T.StructField("gram", T.LongType()), T.StructField("times", T.LongType())]))
        schema = T.StructType([*fields, T.StructField("fold", T.IntegerType()), T.StructField("grams", grams)])

    def run(batches):
        for b in batches:
            for (lang, fold), rows in _groups(b.column(1), b.column(2)):
                ids = b.column(0).take(rows)
                for lo, hi, buf, offs in C.text_slices(b.column(3).take(rows)):
                    c = rule_counts(buf, offs)
                    g, _ = _packed(buf, offs, order)
                    size = np.diff(offs)
                    out = {id_col: ids.slice(lo, hi - lo), "lang": [lang] * (hi - lo), "length": size} | {k: c[k] for k in _COUNTS}
                    if small:
                        at = index.value.find(_keys(lang, fold, g))
                        total = np.zeros(len(g) + 1)
                        np.cumsum(index.value.values[0][at], out=total[1:], dtype=np.float64)
                        out["bits"] = np.where(size > 0, -(total[offs[1:]] - total[offs[:-1]]) / np.maximum(size, 1), 0.0)
                    else:
                        lists = []
                        for a, z in zip(offs[:-1], offs[1:]):
                            u, n = np.unique(g[a:z], return_counts=True)
                            lists.append([{"gram": x, "times": y} for x, y in zip(u.view(np.int64).tolist(), n.tolist())])
                        out |= {"fold": [fold] * (hi - lo), "grams": lists}
                    yield C.arrow_rows(schema, **out)

    if small:
        return source.mapInArrow(C.tidy(run), schema)
    rows = C.materialise(source.mapInArrow(C.tidy(run), schema).withColumn("__row", F.monotonically_increasing_id()), "grams")
    parts = rows.select("__row", "lang", "fold", F.explode("grams").alias("g")).select("__row", "lang", "fold", "g.gram", "g.times")
    sums = parts.join(model, ["lang", "fold", "gram"]).groupBy("__row").agg(F.sum(F.col("logp").cast("double") * F.col("times")).alias("s"))
    bits = F.when(F.col("length") > 0, -F.col("s") / F.col("length")).otherwise(0.0)
    return rows.join(sums, "__row", "left").select(id_col, "lang", *_COUNTS, "length", bits.alias("bits"))


def perplexity_bands(scored: DataFrame, floor: float = 0.02, prior: float = 2.0, step: float = 0.002) -> DataFrame:
    """(lang, middle, noise, floor): a language's median bits, and what a text's
    bits may stray from it: noise over the root of its bytes, and floor. noise is
    the robust deviation of (bits - median) times that root. Both come from
    histograms of all scored documents, so from bins, exact at any size.

    Languages with few documents borrow from all: their middle and noise shrink
    towards those of all documents, which weigh as much as `prior` documents of
    the language. How far the middle moved by that is how little is known of it,
    and widens the floor; and both widen by 6 over the root of the documents: few
    documents say little of spread, and a near copy in the other fold tells their
    model much. One rule for every number."""
    from pyspark.sql.window import Window

    def middle(rows: DataFrame, value, name: str) -> DataFrame:
        # some thousand bins for a language; the null language stands for all
        bins = rows.groupBy("lang", F.floor(value).cast("long").alias("bin")).agg(F.count("*").alias("count"))
        bins = C.materialise(bins, "bins")
        bins = bins.unionByName(bins.groupBy("bin").agg(F.sum("count").alias("count")).withColumn("lang", F.lit(None).cast("string")))
        own = Window.partitionBy("lang")
        bins = bins.withColumns({"upto": F.sum("count").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("count").over(own)})
        return C.materialise(bins.where(F.col("upto") * 2 >= F.col("all")).groupBy("lang").agg(F.min("bin").alias(name), F.first("all").alias("all")), "middles")

    mid = middle(scored, F.col("bits") / step, "bin").select("lang", "all", ((F.col("bin") + 0.5) * step).alias("own"))
    of_all = mid.where("lang is null").first()
    mid = mid.where("lang is not null")
    shrunk = lambda own, other: (F.col("all") * own + prior * other) / (F.col("all") + prior)
    mid = mid.withColumn("middle", shrunk(F.col("own"), F.lit(of_all["own"] if of_all else 0.0)))
    strays = scored.join(C.small(mid.select("lang", "own")), "lang")
    spread = middle(strays, F.abs(F.col("bits") - F.col("own")) * F.sqrt("length") * 50, "far").select("lang", (1.4826 * (F.col("far") + 0.5) / 50).alias("noise"))
    noise_of_all = spread.where("lang is null").first()
    out, unsure = mid.join(spread, "lang"), 1 + 6 / F.sqrt(F.col("all") + prior)
    noise = shrunk(F.col("noise"), F.lit(noise_of_all["noise"] if noise_of_all else 0.0))
    return out.select("lang", "middle", (noise * unsure).alias("noise"), ((floor + F.abs(F.col("own") - F.col("middle"))) * unsure).alias("floor"))


def quality_rules(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER, upper: float = 6.0, lower: float = 5.0, min_words: int = 50, repeat_percent: int = 50, broadcast_grams: int = BROADCAST_GRAMS
) -> DataFrame:
    """Counts and verdict of every text.

    Returns id, the five counts, base_failed, kept, lang and bits (the log2 of
    the text's perplexity for a byte). base_failed: fewer than min_words words,
    or over repeat_percent of the words in repeated 3-word windows. kept: not
    base_failed and inside the language's perplexity band, whose edges are
    `upper` and `lower` deviations from its middle (perplexity_bands; they come
    from the documents that the base rules keep).

    One row for each input row; repeated rows are judged alike. A null text is
    empty (base_failed); a null language is a language of its own; a null id
    stays null. An empty table gives an empty result. Columns beside the three
    named play no part, whatever their names. A text is read whole by one task.
    """
    docs = docs.select(id_col, lang_col, text_col)
    model = crossed(count_grams(docs, text_col, lang_col, order), order)
    scored = _scored(docs, model, id_col, text_col, lang_col, order, broadcast_grams)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    scored = C.materialise(scored.withColumn("base_failed", failed), "scored")
    bands = perplexity_bands(scored.where(~F.col("base_failed")))
    out = scored.join(C.small(C.materialise(bands, "bands")), "lang", "left")
    may = F.sqrt(F.col("noise") ** 2 / F.greatest("length", F.lit(1)) + F.col("floor") ** 2)
    inside = (F.col("bits") <= F.col("middle") + upper * may) & (F.col("bits") >= F.col("middle") - lower * may)
    return out.select(id_col, *_COUNTS, "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"), "lang", "bits")


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs).drop("lang", "bits")
