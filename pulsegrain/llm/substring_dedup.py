"""Repeated passages across documents, by prefix-partitioned suffix trees.

A suffix begins at any word with `window` words left in its document. Two of
them hang under one internal node of that depth exactly if their first `window`
words agree, and such nodes are the maximal repeats that matter here. The trees
are never built whole:

1. A window names an anchor, the run of K words in it with the least hash.
   Equal windows name equal anchors, so suffixes whose anchor stands in no
   other row cannot repeat and go no further.
2. The others are dealt out by a key of varying length. It is the anchor where
   few suffixes share that. Under a frequent anchor it is the suffix's own
   first words, one more at a time until few enough suffixes share them.
3. A key's suffixes fit in memory and come with their words. Sorted by words,
   with the common prefix of neighbours counted in words, they give the deep
   internal nodes of the key's subtree; each leaf learns its node's smallest
   document.
4. A prefix that has all `window` words and still too many suffixes is an
   internal node by itself. Its smallest document is found by aggregation
   before and after the shuffle, and its leaves are marked where they are read,
   so that a passage in a third of all documents meets in no task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

#: Words in an anchor.
K = 4
#: A key with more places than GROUP is extended. In larger tables the limit is a
#: SHARE-th of all places, so that the part of the suffixes under frequent keys
#: does not grow with the table, up to MOST, which a task can hold. It is no less
#: than a SPREAD-th, which bounds the list of such keys (24 bytes for each).
GROUP, SHARE, MOST, SPREAD = 2_000, 1_000, 20_000, 4_000_000
#: Bits (a power of two) that say which prefixes are frequent: 16 MB.
FILTER = 1 << 27
#: Rows (runs of suffixes) whose subtrees are built at a time.
BLOCK = 20_000
#: Words that are hashed or compared at a time there.
PIECE = 1 << 16
#: Windows that one row of marks can name.
WIDE = 31


class _Slice:
    """Words, suffixes (windows) and anchors of a slice of texts."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, window: int, k: int):
        self.buf = buf
        self.starts, self.ends, self.first = C.word_bounds(buf, offs)
        self.words = C.span_hashes(buf, self.starts, self.ends)
        n = max(0, len(self.words) - window + 1)
        inside = np.flatnonzero(C.runs_within(self.first, window))
        grams = C.gram_hashes(self.words, k)
        best, shift = grams[:n].copy(), np.zeros(n, np.int16)
        for j in range(1, window - k + 1):
            other = grams[j : j + n]
            less = other < best
            best[less] = other[less]
            shift[less] = j
        self.start = inside  # of each window, as a word of the slice
        self.doc = (np.searchsorted(self.first, inside, "right") - 1).astype(np.int64)
        self.at = inside - self.first[self.doc]  # the same as a word of its text
        self.anchor, self.shift, self.window = best[inside], shift[inside].astype(np.int64), window

    def prefix(self, n: int, of: np.ndarray, other: bool = False) -> np.ndarray:
        """Hash of the first n words of the windows `of`; `other`: an independent one."""
        w = C.mix(self.words ^ np.uint64(0x5851F42D4C957F2D)) if other else self.words
        return C.mix(C.gram_hashes(w, n)[self.start[of]] + np.uint64(n))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, text, places) of each text's distinct anchors."""
        where = self.start + self.shift
        new = np.ones(len(where), bool)
        new[1:] = (self.doc[1:] != self.doc[:-1]) | (where[1:] != where[:-1])
        anchor, doc = self.anchor[new], self.doc[new]
        _, at, places = np.unique(_doc_keys(anchor, doc), return_index=True, return_counts=True)
        return anchor[at], doc[at], places

    def text(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The text from the first word of windows `first` to the last of `last`."""
        return C.cut_texts(self.buf, self.starts[self.start[first]], self.ends[self.start[last] + self.window - 1])


def _doc_keys(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return C.mix(values + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any of the columns."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _last(heads: np.ndarray, n: int) -> np.ndarray:
    return np.append(heads[1:], n) - 1


# ---------------------------------------------------------------- keys
def key_limit(places: int, group: int = GROUP) -> int:
    """Most places of a key in a table with so many places of shared anchors."""
    return max(group, min(MOST, places // SHARE), places // SPREAD)


def _anchor_counts(docs: DataFrame, id_col: str, text_col: str, window: int, k: int) -> DataFrame:
    """(anchor, rows, places): in how many rows each anchor stands, and how often."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "rows", "places")])

    def run(batches):
        for b in batches:
            for _, _, buf, offs in C.text_slices(b.column(0)):
                anchor, _, places = _Slice(buf, offs, window, k).anchors()
                names, which, rows = np.unique(anchor, return_inverse=True, return_counts=True)
                if len(names):
                    yield C.arrow_rows(schema, anchor=names.view(np.int64), rows=rows, places=np.bincount(which, places).astype(np.int64))

    found = docs.where(F.col(id_col).isNotNull()).select(text_col).mapInArrow(C.tidy(run), schema)
    return found.groupBy("anchor").agg(F.sum("rows").alias("rows"), F.sum("places").alias("places"))


def _anchor_ids(docs: DataFrame, hot, id_col: str, text_col: str, window: int, k: int) -> DataFrame:
    """(anchor, id): each anchor of each row once, without the frequent ones."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), docs.schema[id_col]])

    def run(batches):
        for b in batches:
            for lo, _, buf, offs in C.text_slices(b.column(1)):
                anchor, doc, _ = _Slice(buf, offs, window, k).anchors()
                rare = hot.value.find(anchor) < 0
                yield C.arrow_rows(schema, anchor=anchor[rare].view(np.int64), **{id_col: b.column(0).take(pa.array(doc[rare] + lo))})

    return docs.where(F.col(id_col).isNotNull()).select(id_col, text_col).mapInArrow(C.tidy(run), schema)


def _window_counts(docs: DataFrame, hot, id_col: str, text_col: str, window: int, k: int) -> DataFrame:
    """(h1, h2, places, least, shorter) of the distinct windows under frequent
    anchors: least is a document id, shorter the hashes of the window's prefixes
    of more than k words. A window is one row for each batch that has it."""
    hashes, values = [T.StructField(n, T.LongType()) for n in ("h1", "h2")], T.StructField("places", T.LongType())
    names = [f"p{n}" for n in range(k + 1, window)]
    schema = T.StructType([*hashes, values, T.StructField("least", docs.schema[id_col].dataType), *[T.StructField(n, T.LongType()) for n in names]])

    def once(h1, h2, places, own, shorter):
        order = np.lexsort((own, h2, h1))
        h1, h2, places = h1[order], h2[order], places[order]
        head = _runs(h1, h2)
        return h1[head], h2[head], np.add.reduceat(places, head), own[order[head]], [p[order[head]] for p in shorter]

    def run(batches):
        for b in batches:
            ids, found = b.column(0).to_numpy(), []
            for lo, _, buf, offs in C.text_slices(b.column(1)):
                s = _Slice(buf, offs, window, k)
                under = np.flatnonzero(hot.value.find(s.anchor) >= 0)
                if len(under):
                    shorter = [s.prefix(n, under) for n in range(k + 1, window)]
                    found.append(once(s.prefix(window, under), s.prefix(window, under, True), np.ones(len(under), np.int64), ids[s.doc[under] + lo], shorter))
            if found:
                *whole, shorter = zip(*found)
                h1, h2, places, least, shorter = once(*map(np.concatenate, whole), [np.concatenate(p) for p in zip(*shorter)])
                yield C.arrow_rows(schema, h1=h1.view(np.int64), h2=h2.view(np.int64), places=places, least=least, **{n: p.view(np.int64) for n, p in zip(names, shorter)})

    found = docs.where(F.col(id_col).isNotNull()).select(id_col, text_col).mapInArrow(C.tidy(run), schema)
    found = found.groupBy("h1", "h2").agg(F.sum("places").alias("places"), F.min("least").alias("least"), *[F.min(n).alias(n) for n in names])
    shorter = F.array(*names).cast("array<bigint>")
    return found.select("h1", "h2", "places", "least", shorter.alias("shorter"))


def _frequent(windows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(h1 of the prefixes; h1, h2 and least of the whole windows) with more than
    `limit` places. The prefixes are counted from distinct windows."""
    prefixes = windows.select("places", F.posexplode("shorter").alias("words", "h1")).groupBy("words", "h1").agg(F.sum("places").alias("places"))
    over = F.col("places") > limit
    return prefixes.where(over).select("h1"), windows.where(over).select("h1", "h2", "least")


def _filter(prefixes: DataFrame) -> np.ndarray:
    """FILTER bits, set where the hash of a prefix falls. Bits are put together
    in words before they come to the driver, at most FILTER / 64 rows."""
    bit = F.expr("bit_or(shiftleft(1L, cast(h1 & 63 as int)))")
    table = prefixes.groupBy(F.shiftright(F.col("h1").bitwiseAND(F.lit(FILTER - 1)), 6).alias("at")).agg(bit.alias("bits")).toArrow()
    out = np.zeros(FILTER >> 6, np.uint64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


class _Keys:
    """Which suffixes have a frequent key: anchors, prefixes, and whole windows,
    which are nodes with a smallest document. Prefixes shorter than a window are
    bits of a filter. A false hit makes a key longer than it need be, and does so
    for all suffixes with that prefix alike, so that equal windows still meet."""

    def __init__(self, anchors: np.ndarray, frequent: tuple[DataFrame, DataFrame] | None, window: int, k: int):
        self.anchors, self.window, self.k = C.HashIndex(anchors.view(np.uint64)), window, k
        if frequent is not None:
            self.filter = _filter(frequent[0])
            nodes = frequent[1].toArrow()
            h1, h2 = (nodes.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            self.nodes = C.HashIndex(h1, h2, nodes.column("least").to_numpy())

    def frequent(self, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(len(self.filter) * 64 - 1)
        return (self.filter[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    def deal(self, s: _Slice, under: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, whether it is a node, the node's smallest document) of the
        suffixes `under` frequent anchors."""
        key, least = np.zeros(len(under), np.uint64), np.zeros(len(under), np.int64)
        left = np.arange(len(under))
        for n in range(self.k + 1, self.window):
            h = s.prefix(n, under[left])
            key[left] = h
            left = left[self.frequent(h)]
            if not len(left):
                return key, np.zeros(len(under), bool), least
        node = np.zeros(len(under), bool)
        key[left] = h = s.prefix(self.window, under[left])
        own = self.nodes.find(h)
        second, smallest = self.nodes.values
        hit = np.flatnonzero(own >= 0)
        hit = hit[second[own[hit]] == s.prefix(self.window, under[left[hit]], True)]
        node[left[hit]], least[left[hit]] = True, smallest[own[hit]]
        return key, node, least


# ---------------------------------------------------------------- subtrees
def _pieces(n: int) -> list[slice]:
    return [slice(lo, lo + PIECE) for lo in range(0, n, PIECE)]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words, a piece at a time: a hash takes many times its bytes."""
    cut = ((starts[p], ends[p]) for p in _pieces(len(starts)))
    return np.concatenate([np.zeros(0, np.uint64), *[C.span_hashes(buf[a[0] : z[-1]], a - a[0], z - a[0]) for a, z in cut]])


def word_codes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None) -> np.ndarray:
    """A number for each word, equal exactly for equal words: hashes name the
    words and their bytes are compared with the first word of that hash."""
    _, first, code = np.unique(word_hashes(buf, starts, ends) if hashes is None else hashes, return_index=True, return_inverse=True)
    size = ends - starts
    like = first[code]
    same = lambda p: (buf[C.ragged(starts[p], size[p])] == buf[C.ragged(starts[like[p]], size[p])]).all()
    if (size == size[like]).all() and all(same(p) for p in _pieces(len(starts))):
        return code
    names: dict[bytes, int] = {}
    raw = buf.tobytes()
    return np.array([names.setdefault(raw[a:z], len(names)) for a, z in zip(starts.tolist(), ends.tolist())], np.int64)


def deep_nodes(codes: np.ndarray, key: np.ndarray, start: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The internal nodes of at least `window` words in the subtrees of the
    suffixes: (suffixes in the order of their words, within it the first leaf of
    each node and the end). Leaves of a node are in the order of their documents.
    start: of each suffix in codes; key: its subtree."""
    columns = [codes[start + j] for j in range(window)]
    order = np.lexsort((doc, *columns[::-1], key))
    key = key[order]
    going = key[1:] == key[:-1]
    common = np.zeros(len(going), np.int64)  # words that neighbours share
    for c in columns:
        c = c[order]
        going &= c[1:] == c[:-1]
        common += going
    return order, np.append(np.flatnonzero(np.append(True, common < window)), len(order))


def _marked(table: pa.Table, id_col: str, window: int) -> np.ndarray:
    """Bits of the suffixes of each run that are in a document after their
    node's first. The table holds whole keys."""
    _, _, buf, offs = next(C.text_slices(table.column("span"), 1 << 60))
    starts, ends, first = C.word_bounds(buf, offs)
    many = np.maximum(np.diff(first) - window + 1, 0)  # suffixes of each run
    run = np.repeat(np.arange(len(many)), many)
    start = C.ragged(first[:-1], many)
    key, doc = table.column("key").to_numpy()[run], table.column(id_col).to_numpy()[run]
    # suffixes whose first words occur once hang from no deep node
    hashes = word_hashes(buf, starts, ends)
    h = C.mix(C.gram_hashes(hashes, window)[start] ^ C.mix(key.view(np.uint64)))
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    often = order[np.append(same, False) | np.append(False, same)]
    bits = np.zeros(len(many), np.int64)
    if len(often):
        order, head = deep_nodes(word_codes(buf, starts, ends, hashes), key[often], start[often], doc[often], window)
        leaf = often[order]
        least = np.repeat(doc[leaf[head[:-1]]], np.diff(head))
        hit = leaf[doc[leaf] > least]
        np.bitwise_or.at(bits, run[hit], np.int64(1) << (start[hit] - first[run[hit]]))
    return bits


def repeated_windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 13, group: int = GROUP) -> DataFrame:
    """(id, at, bits): window at + j of the document also starts in a document
    with a smaller id, for each bit j that is set. Ids are integers; rows with
    a null id neither lose nor claim windows; rows of one id are one document.
    """
    k = min(K, window)
    if window - k >= WIDE:
        raise ValueError("window too long")
    spark = docs.sparkSession
    docs = docs.select(id_col, text_col)
    shared = C.materialise(_anchor_counts(docs, id_col, text_col, window, k).where("rows > 1").select("anchor", "places"), "shared")
    # a key's suffixes are its places, which one text can have many of
    limit = key_limit(shared.agg(F.sum("places")).first()[0] or 0, group)
    # fewer than SPREAD by the limit
    anchors = shared.where(F.col("places") > limit).select("anchor").toArrow().column(0).to_numpy()
    hot = spark.sparkContext.broadcast(C.HashIndex(anchors.view(np.uint64)))
    frequent = None
    if len(anchors):
        # frequent whole windows alone come to the driver, fewer than SPREAD
        frequent = _frequent(C.materialise(_window_counts(docs, hot, id_col, text_col, window, k), "windows"), limit)
    keys = spark.sparkContext.broadcast(_Keys(anchors, frequent, window, k))
    few = _anchor_ids(docs, hot, id_col, text_col, window, k).join(shared.where(F.col("places") <= limit).select("anchor"), "anchor")
    few = few.groupBy(id_col).agg(F.collect_list("anchor").alias("__shared"))
    # a left join, as in remove_repeats: both read the same shuffle of the texts
    flagged = docs.join(few, id_col, "left")
    schema = T.StructType([T.StructField("key", T.LongType()), docs.schema[id_col], T.StructField("at", T.IntegerType()), T.StructField("bits", T.IntegerType()), T.StructField("span", T.StringType())])

    def deal(batches):
        for b in batches:
            b = b.filter(pa.compute.is_valid(b.column(0)))
            for lo, hi, buf, offs in C.text_slices(b.column(1)):
                s = _Slice(buf, offs, window, k)
                lists = b.column(2).slice(lo, hi - lo)
                sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
                wanted = _doc_keys(np.asarray(lists.flatten()).view(np.uint64), np.repeat(np.arange(hi - lo), sizes))
                hit = np.flatnonzero(np.isin(_doc_keys(s.anchor, s.doc), wanted))
                ids = b.column(0).slice(lo, hi - lo)
                if len(hit):
                    head = _runs(s.doc[hit], s.start[hit] + s.shift[hit])
                    last = _last(head, len(hit))
                    head, last = hit[head], hit[last]
                    yield C.arrow_rows(schema, key=s.anchor[head].view(np.int64), at=s.at[head].astype(np.int32), bits=np.zeros(len(head), np.int32), span=s.text(head, last), **{id_col: ids.take(pa.array(s.doc[head]))})
                under = np.flatnonzero(keys.value.anchors.find(s.anchor) >= 0)
                if not len(under):
                    continue
                key, node, least = keys.value.deal(s, under)
                one = under[~node]
                if len(one):
                    yield C.arrow_rows(schema, key=key[~node].view(np.int64), at=s.at[one].astype(np.int32), bits=np.zeros(len(one), np.int32), span=s.text(one, one), **{id_col: ids.take(pa.array(s.doc[one]))})
                leaf = np.flatnonzero(node)
                leaf = leaf[ids.to_numpy()[s.doc[under[leaf]]] > least[leaf]]
                if len(leaf):
                    leaf = under[leaf]
                    head = _runs(s.doc[leaf], s.at[leaf] // WIDE)
                    at = s.at[leaf] // WIDE * WIDE
                    bits = np.bitwise_or.reduceat(np.int64(1) << (s.at[leaf] - at), head)
                    spread = C.mix(C.mix(s.doc[leaf[head]].astype(np.uint64)) + s.at[leaf[head]].astype(np.uint64))
                    yield C.arrow_rows(schema, key=spread.view(np.int64), at=at[head].astype(np.int32), bits=bits.astype(np.int32), span=pa.nulls(len(head), pa.string()), **{id_col: ids.take(pa.array(s.doc[leaf[head]]))})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = flagged.mapInArrow(C.tidy(deal), schema).repartition(parts, "key").sortWithinPartitions("key")
    result = T.StructType([docs.schema[id_col], T.StructField("at", T.IntegerType()), T.StructField("bits", T.IntegerType())])

    def subtrees(table: pa.Table):
        done = table.filter(pa.compute.is_null(table.column("span")))
        table = table.filter(pa.compute.is_valid(table.column("span")))
        for part, bits in ((done, done.column("bits").to_numpy()), (table, _marked(table, id_col, window) if table.num_rows else np.zeros(0, np.int64))):
            got = np.flatnonzero(bits)
            if len(got):
                part = part.take(pa.array(got))
                yield C.arrow_rows(result, at=part.column("at").combine_chunks(), bits=bits[got].astype(np.int32), **{id_col: part.column(id_col).combine_chunks()})

    def build(batches):
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= BLOCK:
                table = pa.Table.from_batches(held)
                cut = int(np.searchsorted(table.column("key").to_numpy(), b.column(0)[b.num_rows - 1].as_py()))  # the last key may go on
                if cut:
                    yield from subtrees(table.slice(0, cut))
                    rest = table.slice(cut)
                    held, n = rest.to_batches(), rest.num_rows
        if n:
            yield from subtrees(pa.Table.from_batches(held))

    return dealt.mapInArrow(C.tidy(build), result)


# ---------------------------------------------------------------- removal
def _covered(n: int, packed, window: int) -> np.ndarray:
    """Which of n words the windows cover; packed: at << 32 | bits."""
    packed = np.asarray(packed, np.int64)
    at, bits = packed >> 32, packed & 0xFFFFFFFF
    step = np.zeros(n + 1, np.int64)
    for j in range(32):
        start = at[(bits >> j) & 1 == 1] + j
        start = start[(start >= 0) & (start <= n - window)]
        if j and not len(start) and not (bits >> j).any():
            break
        np.add.at(step, start, 1)
        np.add.at(step, start + window, -1)
    return np.cumsum(step[:n]) > 0


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 13, group: int = GROUP, digest: bool = False, counts: bool = True) -> DataFrame:
    """docs without the words of repeated passages.

    A word goes if a window of `window` words that covers it also starts in a
    document with a smaller id; windows are judged on the input. Kept words
    keep the blanks after them; a text that loses nothing is unchanged. All
    columns of docs stay. With counts, n_words and n_removed follow (columns of
    docs with these names give way to them); with digest, the result is the id,
    the two counts and kept_sha256 (of the kept words joined by one space).

    Null texts have no words and stay null. Rows with a null id lose nothing.
    Rows with one id count as one document: each loses what was found in any.
    A text of any length is read whole by one task. An empty table gives an
    empty result; any other columns pass through, whatever their names.
    """
    found = repeated_windows(docs, id_col=id_col, text_col=text_col, window=window, group=group)
    packed = F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("bits").cast("long"))
    (marks_col,) = C.fresh(docs, "__marks")
    marks = found.groupBy(id_col).agg(F.collect_list(packed).alias(marks_col))
    counts = counts or digest
    own = ["n_words", "n_removed"] if counts else []
    names = [id_col, text_col] if digest else [c for c in docs.columns if c.lower() not in own]
    fields = [T.StructField(c, T.LongType()) for c in own]
    if digest:
        schema = T.StructType([docs.schema[id_col], *fields, T.StructField("kept_sha256", T.StringType())])
    else:
        schema = T.StructType([*docs.select(*names).schema.fields, *fields])

    def run(batches):
        for b in batches:
            texts, lists = b.column(names.index(text_col)), b.column(b.num_columns - 1)
            words_n, removed, out = [], [], []
            for text, mark in zip(texts, lists):
                raw = (text.as_py() or "").encode()
                words = raw.split()
                gone = _covered(len(words), mark.values, window) if mark.is_valid else None
                lost = int(gone.sum()) if gone is not None else 0
                words_n.append(len(words))
                removed.append(lost)
                if digest:
                    kept = [w for w, g in zip(words, gone) if not g] if lost else words
                    out.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                elif not lost:
                    out.append(text.as_py())
                else:
                    buf = np.frombuffer(raw, np.uint8)
                    starts, _, _ = C.word_bounds(buf, np.array([0, len(buf)]))
                    edges = np.append(starts, len(raw))
                    keep = np.concatenate([[True], ~gone])
                    spans = zip(np.concatenate([[0], starts])[keep], edges[keep])
                    out.append(b"".join(raw[a:z] for a, z in spans).decode())
            values = {"n_words": words_n, "n_removed": removed} if counts else {}
            if digest:
                yield C.arrow_rows(schema, **{id_col: b.column(0), **values, "kept_sha256": out})
            else:
                yield C.arrow_rows(schema, **({n: b.column(i) for i, n in enumerate(names)} | {text_col: pa.array(out, pa.string())} | values))

    return docs.select(*names).join(marks, id_col, "left").select(*names, marks_col).mapInArrow(C.tidy(run), schema)


#: Words are found with a pattern, windows are lists of 13 of them.
OP5_SQL = """
with words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents
), windows as (
    select doc_id, s as start, array_to_string(w[s : s + 12], ' ') as passage
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) as s from words)
), firsts as (
    select passage, min(doc_id) as least from windows group by passage
), gone as (
    select distinct x.doc_id, x.start + d.j as place
    from windows x join firsts f on x.passage = f.passage and x.doc_id > f.least, (select unnest(range(0, 13)) as j) d
), lost as (
    select doc_id, list(place) as places from gone group by doc_id
)
select k.doc_id, len(k.w)::bigint as n_words, coalesce(len(l.places), 0)::bigint as n_removed,
    sha256(array_to_string(case when l.places is null then k.w else list_filter(k.w, lambda x, i: not list_contains(l.places, i)) end, ' ')) as kept_sha256
from words k left join lost l on k.doc_id = l.doc_id
"""


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """What every document keeps after repeated passages of 13 words go."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, digest=True)
