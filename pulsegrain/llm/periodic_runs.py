"""Periodic runs of words, by enumerating maximal pairs.

A run of period p that is l + p words long is a pair of suffixes, p words apart,
that agree in l words and no more (right-maximal) and that different words
precede (left-maximal). So the maximal pairs whose distance is at most
l / (powers - 1) are exactly the runs, and none has to be extended:

1. Only suffixes whose first words come again close by in their text can be in
   such a pair. A sort of hashed n-grams finds them; the others are in none of
   the deep intervals and are left out.
2. The words of the texts concerned get exact numbers. Prefix doubling sorts
   the suffixes left, and its ranks give the common prefixes of neighbours.
3. The tree of common-prefix intervals is walked from the bottom. Each interval
   has its places, also as lists by the word before them. Where two intervals
   join, every place of the smaller one asks the lists of other words of the
   larger one for partners within the distance.

A text is one task's work; texts are never grouped, so nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _seed_words(least: int, powers: int) -> int:
    """The fewest words that the two suffixes of a run agree in."""
    return min(max(least, powers * p) - p for p in range(1, least + 1))


def suspects(grams: np.ndarray, k: int, powers: int) -> np.ndarray:
    """The places whose n-gram comes again near enough for a run.

    In a run, the n-grams of l - k + 1 places in a row come again within the
    period, and the period is at most l / (powers - 1). So a place counts only if
    its n-gram comes again within the distance that its stretch of such places
    allows. Partners are at most that distance further."""
    n = len(grams)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    gap = np.full(n, np.iinfo(np.int64).max // powers)
    a, b = order[:-1][same], order[1:][same]
    gap[a] = b - a
    again = np.zeros(n, bool)
    again[a] = again[b] = True
    open_ = gap < n
    while True:
        edge = np.diff(np.concatenate([[0], open_.astype(np.int8), [0]]))
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        far = np.repeat((hi - lo + k - 1) // (powers - 1), hi - lo)
        at = np.flatnonzero(open_)
        out = at[gap[at] > far]
        if not len(out):
            break
        open_[out] = False
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, np.minimum(hi + (hi - lo + k - 1) // (powers - 1), n), -1)
    return np.flatnonzero((np.cumsum(step[:n]) > 0) & again)


def suffix_ranks(ids: np.ndarray, first: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    """Ranks of the first 1, 2, 4, ... words of all suffixes, until those of
    `places` differ. ids: numbers of words, different in every text; a suffix
    ends with its text."""
    n = len(ids)
    end = np.repeat(first[1:], np.diff(first))
    values, back = np.unique(ids, return_inverse=True)
    heads = np.cumsum(np.bincount(back, minlength=len(values))) - np.bincount(back, minlength=len(values))
    levels, length = [heads[back].astype(np.int32)], 1
    wanted = np.zeros(n, bool)
    wanted[places] = True
    rest = np.flatnonzero(np.bincount(back, minlength=len(values))[back] > 1)
    while len(rest) and wanted[rest].any():
        rank = levels[-1]
        ahead = rest + length
        inside = ahead < end[rest]
        key = rank[rest].astype(np.int64) * (n + 1) + np.where(inside, rank[np.minimum(ahead, n - 1)].astype(np.int64) + 1, 0)
        order = np.argsort(key)
        rest, key = rest[order], key[order]
        old = key // (n + 1)
        group = np.append(True, old[1:] != old[:-1])
        head = np.append(True, key[1:] != key[:-1])
        at = np.arange(len(rest))
        begin = np.maximum.accumulate(np.where(group, at, 0))
        new = rank.copy()
        new[rest] = old + np.maximum.accumulate(np.where(head, at, 0)) - begin
        levels.append(new)
        sizes = np.diff(np.append(np.flatnonzero(head), len(rest)))
        rest = rest[np.repeat(sizes, sizes) > 1]
        length *= 2
    return levels


def _common(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray, end: np.ndarray) -> np.ndarray:
    """In how many words suffixes x and y agree; ranks of longer runs first."""
    x, y, out = x.copy(), y.copy(), np.zeros(len(x), np.int64)
    limit = end - np.maximum(x, y)
    n = len(levels[0])
    for h in range(len(levels) - 1, -1, -1):
        hit = (out < limit) & (levels[h][np.minimum(x, n - 1)] == levels[h][np.minimum(y, n - 1)])
        step = np.where(hit, 1 << h, 0)
        x, y, out = x + step, y + step, out + step
    return out


def _join(a: tuple, b: tuple, depth: int, left: list, least: int, powers: int, found: list) -> tuple:
    """Two parts of an interval in one; their maximal pairs go to found."""
    if len(a[0]) < len(b[0]):
        a, b = b, a
    places, classes = a
    reach, near = depth // (powers - 1), least - depth
    for x in b[0]:
        lo, hi = bisect_left(places, x - reach), bisect_right(places, x + reach)
        if lo == hi:
            continue
        own = left[x]
        if hi - lo <= len(classes):
            other = [y for y in places[lo:hi] if left[y] != own]
        else:
            other = [y for word, ys in classes.items() if word != own for y in ys[bisect_left(ys, x - reach) : bisect_right(ys, x + reach)]]
        for y in other:
            if abs(x - y) >= near:
                found.append((min(x, y), depth + abs(x - y), abs(x - y)))
    for x in b[0]:
        insort(places, x)
    for word, ys in b[1].items():
        if word in classes:
            into = classes[word]
            for y in ys:
                insort(into, y)
        else:
            classes[word] = ys
    return a


def maximal_pairs(places: list[int], shared: list[int], left: list[int], least: int, powers: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal pairs near enough. places: sorted
    suffixes; shared[i]: the words that places[i] shares with the one before;
    left: the word before each place."""
    k = _seed_words(least, powers)
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, tuple]] = []
    now = None
    for s, depth in zip(places + [-1], shared + [0]):
        if now is not None:
            while stack and stack[-1][0] > depth:
                d, part = stack.pop()
                now = _join(part, now, d, left, least, powers, found)
            if depth >= k:
                if stack and stack[-1][0] == depth:
                    stack[-1] = (depth, _join(stack[-1][1], now, depth, left, least, powers, found))
                else:
                    stack.append((depth, now))
        if s >= 0:
            now = ([s], {left[s]: [s]})
    return found


def slice_runs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, least: int, powers: int) -> np.ndarray:
    """(text, start, length, period) rows, in that order, of a slice's runs.
    start is the word's number in its text."""
    k = _seed_words(least, powers)
    none = np.zeros((0, 4), np.int64)
    inside = C.runs_within(first, k)
    if not inside.any():
        return none
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    # places in a row stay so: n-grams that cross texts are numbered apart
    grams = C.gram_hashes(C.span_hashes(buf, starts, ends), k) + doc[: len(inside)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    grams[~inside] = np.arange(len(grams), dtype=np.uint64)[~inside]
    kept = suspects(grams, k, powers)
    kept = kept[inside[kept]]
    if not len(kept):
        return none
    texts = np.unique(doc[kept])
    size = np.diff(first)[texts]
    words = C.ragged(first[texts], size)
    lead = np.concatenate([[0], np.cumsum(size)])
    text = np.repeat(np.arange(len(texts)), size)
    code = C.cut_texts(buf, starts[words], ends[words]).cast(pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    ids = text * (int(code.max()) + 1) + code
    places = (lead[:-1] - first[texts])[np.searchsorted(texts, doc[kept])] + kept
    levels = suffix_ranks(ids, lead, places)
    places = places[np.argsort(levels[-1][places], kind="stable")]
    end = lead[text[places] + 1]
    shared = np.zeros(len(places), np.int64)
    together = np.flatnonzero(text[places[1:]] == text[places[:-1]]) + 1
    shared[together] = _common(levels, places[together], places[together - 1], end[together])
    left = np.where(places > lead[text[places]], ids[places - 1], -1)
    found = maximal_pairs(places.tolist(), shared.tolist(), dict(zip(places.tolist(), left.tolist())), least, powers)
    if not found:
        return none
    runs = np.array(found, np.int64)
    # a multiple of a run's period is a pair with the same words
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))]
    which = text[runs[:, 0]]
    runs = np.column_stack([texts[which], runs[:, 0] - lead[which], runs[:, 1], runs[:, 2]])
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _joined(buf: np.ndarray, offs: np.ndarray, ends: np.ndarray, starts: np.ndarray, first: np.ndarray, gone: np.ndarray) -> pa.Array:
    """The words that are not gone of every text, joined by one space."""
    mask = ~C.SEPARATORS[buf]
    lost = np.flatnonzero(gone)
    mask[C.ragged(starts[lost], ends[lost] - starts[lost])] = False
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    kept = np.flatnonzero(~gone)
    inner = kept[:-1][doc[kept[1:]] == doc[kept[:-1]]]
    mask[ends[inner]] = True  # a word has a separator after it if another follows
    total = np.concatenate([[0], np.cumsum(mask)])
    out = np.where(C.SEPARATORS[buf], np.uint8(32), buf)[mask]
    return pa.LargeStringArray.from_buffers(len(offs) - 1, pa.py_buffer(total[offs].astype(np.int64)), pa.py_buffer(out))


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 6, powers: int = 4) -> DataFrame:
    """The periodic runs of every text, and the text without their repeats.

    A run is a stretch of words with the smallest period q (words q apart are
    the same) and at least max(least, powers * q) words, which no word next to
    it extends with that period. Returns id, runs (start as a word number from
    0, length, period; by start, then period) and collapsed: the words, joined
    by one space, without those that a run holds after its first q words.

    One row for each input row, repeated rows and null ids included. Null texts
    and texts without words have no run and collapse to ''. An empty table gives
    an empty result; other columns play no part, whatever their names. A text
    of any length is read whole by one task, with memory in proportion to its
    words and the logarithm of its longest repeat; it needs powers >= 2.
    """
    if powers < 2 or least < 2:
        raise ValueError("runs need two powers and two words at least")
    names = C.fresh(docs.select(id_col), "runs", "collapsed")
    schema = T.StructType([docs.schema[id_col], T.StructField(names[0], T._parse_datatype_string(RUN)), T.StructField(names[1], T.StringType())])

    def run(batches):
        for b in batches:
            for lo, hi, buf, offs in C.text_slices(b.column(1)):
                starts, ends, first = C.word_bounds(buf, offs)
                runs = slice_runs(buf, starts, ends, first, least, powers)
                step = np.zeros(len(starts) + 1, np.int64)
                begin = first[runs[:, 0]] + runs[:, 1]
                np.add.at(step, begin + runs[:, 3], 1)
                np.add.at(step, begin + runs[:, 2], -1)
                collapsed = _joined(buf, offs, ends, starts, first, np.cumsum(step[:-1]) > 0)
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(runs[:, 0], np.arange(hi - lo + 1)), pa.int32()), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, i])) for i in (1, 2, 3)], ["start", "length", "period"]))
                yield C.arrow_rows(schema, **{id_col: b.column(0).slice(lo, hi - lo), names[0]: lists, names[1]: collapsed})

    return docs.select(id_col, text_col).mapInArrow(C.tidy(run), schema)


def with_planted_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and text; in the tenth of the documents whose hash h of the id ends in
    0, the words from number a on repeat the p words that begin there, where
    g = floor(h / 10), a = g mod n and p = 1 + floor((n - a) / (3 + g mod 8))."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("int")
    words = F.filter(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def tail(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.concat_ws(" ", F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(w, F.when(i < a, i).otherwise(a + (i - a) % p) + 1)))

    # the words are a variable here, so that they are found once for each text
    planted = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(F.lit("")))
    return docs.select(id_col, F.when((h % 10 == 0) & F.col(text_col).isNotNull(), planted[0]).otherwise(F.col(text_col)).alias(text_col))


def run_digests(runs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """periodic_runs as counts, its greatest run and checksums."""
    r = F.col("runs")
    nothing = F.struct(*[F.lit(v).cast("bigint").alias(k) for k, v in (("start", 0), ("length", 0), ("period", 1))])
    # exponents are compared as products, so exactly; of equal ones the first stays
    best = F.reduce(r, nothing, lambda acc, x: F.when(x["length"] * acc["period"] > acc["length"] * x["period"], x).otherwise(acc))
    best = F.when(F.size(r) > 0, best)
    lines = F.array_join(F.transform(r, lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n"))), "")
    out = runs.select(id_col, F.size(r).cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exact = F.expr("(1000 * best.length) div best.period")
    return out.select(id_col, "n_runs", "best.start", "best.length", "best.period", exact.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


#: Stretches of words that are the same a period apart are found as islands.
OP11_SQL = f"""
with recursive {C.CRC_TABLE_SQL}, split as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
        {C.crc_sql("doc_id::varchar")} as h
    from documents, crc
), sized as (
    select doc_id, w, h, h // 10 as g, len(w) as n from split
), placed as (
    select *, case when n > 0 then g % n end as a from sized
), planned as (
    select *, case when n > 0 then 1 + (n - a) // (3 + g % 8) end as p from placed
), words as (
    select doc_id, case when h % 10 = 0 and n > 0 then list_transform(range(0, n), lambda i: w[(case when i < a then i else a + (i - a) % p end) + 1]) else w end as w
    from planned
), places as (
    select doc_id, unnest(w) as word, unnest(range(0, len(w))) as i, len(w) as n from words
), same as (
    select x.doc_id, x.i, y.i - x.i as p from places x join places y on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and (y.i - x.i) * 4 <= x.n
), islands as (
    select doc_id, p, min(i) as start, count(*) + p as length
    from (select *, i - row_number() over (partition by doc_id, p order by i) as island from same) group by doc_id, p, island
), runs as (
    select doc_id, start, length, min(p) as period from islands where length >= greatest(6, 4 * p) group by doc_id, start, length
), gone as (
    select distinct doc_id, unnest(range(start + period, start + length)) as i from runs
), lost as (
    select doc_id, list(i) as places from gone group by doc_id
), best as (
    select * from runs qualify row_number() over (partition by doc_id order by length::double / period desc, start, period) = 1
), listed as (
    select doc_id, count(*) as n_runs, string_agg(start::varchar || ',' || length::varchar || ',' || period::varchar || chr(10), '' order by start, period) as lines from runs group by doc_id
)
select w.doc_id, coalesce(l.n_runs, 0)::bigint as n_runs, b.start::bigint as start, b.length::bigint as length, b.period::bigint as period,
    (1000 * b.length // b.period)::bigint as exponent_milli, sha256(coalesce(l.lines, '')) as runs_sha256,
    sha256(coalesce(array_to_string(case when o.places is null then w.w else list_filter(w.w, lambda x, i: not list_contains(o.places, i - 1)) end, ' '), '')) as collapsed_sha256
from words w left join listed l on w.doc_id = l.doc_id left join best b on w.doc_id = b.doc_id left join lost o on w.doc_id = o.doc_id
"""


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of them with planted tails."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return run_digests(periodic_runs(with_planted_tails(docs)))
