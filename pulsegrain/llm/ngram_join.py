"""Similarity join of texts by the Jaccard similarity of their word n-gram sets.

Two sets of at least p percent similarity share one of their first n-grams in
any common order, if each shows its first n - ceil(p n / 100) + 1 (prefix
filter). The order is rare first:

1. One scan names every set (equal sets are one class) and counts in how many
   texts n-grams stand, in a table of hashed slots of fixed size. Tasks count
   what they read; block by block the tables are added up by Spark. Slots shared
   by chance change the order, so the work, and never the result.
2. Each class posts the n-grams of its prefix with its size, the n-gram's place
   and, in eight parts of the hash space, how many of its n-grams come later.
   They are shuffled once: n-grams that only one class posts go, and the rest,
   which is little, is joined on the n-gram.
3. A pair must pass the length filter (the sizes), the positional filter (what
   is left after the places) and the suffix filter (places passed and the parts'
   counts add up to a lower bound of the difference). None loses a pair.
4. Pairs left are made distinct, compared by sketches whose bits can only differ
   as the sets do, and verified once on the whole sets.

Sets of one n-gram and like length are first compared with one of them, in a
star; then only those whose components still differ are paired. So groups of
near copies cost work in proportion to their size, and no link between different
components is left out.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import common as C
from .components import connected_components
from .near_copies import _names, shingle_sets

#: Slots of the table of counts and of a block of it, as powers of two.
SLOT_BITS, BLOCK_BITS = 22, 14
#: The map of texts to read again has at most so many bits (as a power of two).
MAP_BITS = 28
#: Bits of a set's sketch.
SKETCH = 2048
#: Texts of an n-gram's slot from which on its classes are dealt over salts, if
#: they are also 64 times the mean.
DEALT = 100_000
#: Members of a star that meet one copy of its head.
STAR = 512
_LOW = 0xFFFFFFFF


# ---------------------------------------------------------------- one scan
def _slots(g: np.ndarray) -> np.ndarray:
    return (g >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _scan(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, name, n) of every row, and (block, counts) of every task: in how many
    of its texts the n-grams of each slot stand (bytes, or four bytes each)."""
    schema = T.StructType([docs.schema[id_col], T.StructField("__name", T.LongType()), T.StructField("__n", T.LongType()), T.StructField("__block", T.IntegerType()), T.StructField("__counts", T.BinaryType())])
    blocks = 1 << (SLOT_BITS - BLOCK_BITS)

    def run(batches):
        total, waiting, size = np.zeros(1 << SLOT_BITS, np.int64), [], 0
        for b in batches:
            for lo, hi, buf, offs in C.text_slices(b.column(1)):
                g, d = shingle_sets(buf, offs, shingle)
                name, n = _names(g, d, hi - lo)
                waiting.append(_slots(g).astype(np.int32))
                size += len(g)
                if size > 1 << SLOT_BITS:
                    total += np.bincount(np.concatenate(waiting), minlength=len(total))
                    waiting, size = [], 0
                none = [None] * (hi - lo)
                yield C.arrow_rows(schema, **{id_col: b.column(0).slice(lo, hi - lo), "__name": name, "__n": n, "__block": none, "__counts": none})
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=len(total))
        table = total.reshape(blocks, -1)
        for block in np.flatnonzero(table.any(axis=1)):
            row = table[block]
            raw = row.astype(np.uint8) if row.max() < 256 else np.minimum(row, 2**32 - 1).astype(np.uint32)
            yield C.arrow_rows(schema, **{id_col: [None], "__name": [None], "__n": [None], "__block": [int(block)], "__counts": [raw.tobytes()]})

    return docs.select(id_col, text_col).mapInArrow(C.tidy(run), schema)


def _rarity(scanned: DataFrame) -> np.ndarray:
    """A byte for each slot, greater for n-grams of more texts: the counts of all
    tasks, added up by block. Fixed in size, whatever the input."""
    width = 1 << BLOCK_BITS

    def add(batches):
        import pyarrow as pa

        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for block, raw in zip(b.column(0).to_pylist(), b.column(1)):
                raw = np.frombuffer(raw.as_buffer(), np.uint8)
                counts = raw if len(raw) == width else raw.view(np.uint32)
                totals[block] = totals.get(block, 0) + counts.astype(np.int64)
        for block, counts in totals.items():
            byte = np.minimum(8 * np.log2(counts + 1.0), 255).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "bytes": pa.array([byte.tobytes()], pa.binary())})

    parts = scanned.where(F.col("__block").isNotNull()).select("__block", "__counts")
    table = parts.repartition(F.col("__block")).mapInArrow(C.tidy(add), "block int, bytes binary").toArrow()
    out = np.zeros((1 << (SLOT_BITS - BLOCK_BITS), width), np.uint8)
    for block, raw in zip(table.column(0).to_pylist(), table.column(1).to_pylist()):
        out[block] = np.frombuffer(raw, np.uint8)
    return out.ravel()


# ---------------------------------------------------------------- prefixes
def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's n-grams, rare first, it has to show."""
    return n - (percent * n + 99) // 100 + 1


def later_counts(part: np.ndarray, d: np.ndarray, size: np.ndarray, shown: np.ndarray) -> np.ndarray:
    """For each place shown, how many n-grams of its set come later in each of
    eight parts: bytes of a long that stop at 255 (which only lowers differences)."""
    ends = np.cumsum(size)[d[shown]] - 1
    at = np.flatnonzero(shown)
    out = np.zeros((len(at), 8), np.uint8)
    for k in range(8):
        upto = np.cumsum(part == k)
        out[:, k] = np.minimum(upto[ends] - upto[at], 255)
    return out.view(np.int64).ravel()


_POSTING = T.StructType([T.StructField(c, T.LongType()) for c in ("gram", "name", "spot", "later", "salt")])


def _postings(docs: DataFrame, text_col: str, shingle: int, percent: int, rarity) -> DataFrame:
    """(gram, name, spot, later, salt) of every set's prefix; spot is the place
    times 2**32 plus the set's size. Equal sets give equal rows. An n-gram of a
    slot far above the mean has its classes dealt over several salts."""
    often = max(8 * math.log2(DEALT), float(np.mean(rarity.value)) + 48)

    def run(batches):
        table = rarity.value
        salts = np.maximum(1, np.exp2((np.arange(256) - often) / 8)).astype(np.uint64)
        for b in batches:
            for lo, hi, buf, offs in C.text_slices(b.column(0)):
                g, d = shingle_sets(buf, offs, shingle)
                name, size = _names(g, d, hi - lo)
                new = np.zeros(hi - lo, bool)  # equal sets of a slice are shown once
                new[np.unique(name, return_index=True)[1]] = True
                code = table[_slots(g)]
                order = np.lexsort((g, code, d))
                g, d, code = g[order], d[order], code[order]
                place = np.arange(len(g)) - (np.cumsum(size) - size)[d]
                shown = (place < prefix_size(size, percent)[d]) & new[d]
                later = later_counts((C.mix(g) >> np.uint64(61)).astype(np.int64), d, size, shown)
                own, parts = name[d[shown]], salts[code[shown]]
                salt = np.where(parts > 1, C.mix(own.view(np.uint64)) % parts + np.uint64(1), np.uint64(0))
                yield C.arrow_rows(_POSTING, gram=g[shown].view(np.int64), name=own, spot=(place[shown] << 32) + size[d[shown]], later=later, salt=salt.astype(np.int64))

    return docs.select(text_col).mapInArrow(C.tidy(run), _POSTING)


def _met(posts: DataFrame, percent: int) -> DataFrame:
    """The distinct postings of n-grams that several classes of like length post,
    in one shuffle of all: in the order of n-gram and length, a posting that has a
    partner has one beside it. Those with a salt all stay."""

    def run(batches):
        last, told = None, False
        for b in batches:
            rows = np.column_stack([c.to_numpy() for c in b.columns])
            if not len(rows):
                continue
            held = last is not None
            if held:
                rows = np.concatenate([last, rows])
            new = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))
            rows = rows[new]
            size = rows[:, 2] & _LOW
            same = (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 4] == rows[:-1, 4]) & (100 * size[:-1] >= percent * size[1:])
            before = np.append(False, same)
            keep = before | np.append(same, False) | (rows[:, 4] > 0)
            if held and told:
                keep[0] = False
            yield C.arrow_rows(_POSTING, **{f.name: rows[keep, i] for i, f in enumerate(_POSTING)})
            told = bool(keep[-1]) or (len(rows) == 1 and held and told)
            last = rows[-1:]

    return posts.repartition("gram", "salt").sortWithinPartitions("gram", "salt", F.col("spot").bitwiseAND(F.lit(_LOW)), "name").mapInArrow(C.tidy(run), _POSTING)


def may_be_similar(x: str, y: str, percent: int) -> Column:
    """Length, positional and suffix filter of two postings of one n-gram; x and
    y are prefixes of their columns' names. True for the first n-gram that two
    similar sets share."""
    size = [F.col(f"{s}spot").bitwiseAND(F.lit(_LOW)) for s in (x, y)]
    place = [F.shiftright(F.col(f"{s}spot"), 32) for s in (x, y)]
    both = size[0] + size[1]
    length = 100 * F.least(*size) >= percent * F.greatest(*size)
    position = F.least(size[0] - place[0], size[1] - place[1]) * (100 + percent) >= percent * both
    apart = place[0] + place[1]
    for k in range(8):
        a, b = (F.shiftright(F.col(f"{side}later"), 8 * k).bitwiseAND(F.lit(0xFF)) for side in (x, y))
        apart = apart + F.abs(a - b)
    # sets that share o n-grams differ in |a| + |b| - 2 o
    return length & position & (apart * (100 + percent) <= both * (100 - percent))


# ---------------------------------------------------------------- verification
def _id_map(ids: DataFrame, id_col: str, bits: int):
    """A bit for each hash of an id, in words of 64. Its size follows the number
    of ids up to 2**MAP_BITS bits; a bit set by chance costs time only."""
    slot = F.pmod(F.xxhash64(id_col), F.lit(1 << bits))
    words = ids.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("v")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return ids.sparkSession.sparkContext.broadcast(out.view(np.uint64)), slot


def _read_again(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int, sketch: bool) -> DataFrame:
    """(id, __name, __n, __value) of texts that have one of the ids of `wanted`,
    and of some others: the n-grams, or a sketch of them."""
    bits = min(max(16, math.ceil(math.log2(16 * max(wanted.count(), 1)))), MAP_BITS)
    bitmap, slot = _id_map(wanted, id_col, bits)
    schema = T.StructType([docs.schema[id_col], T.StructField("__name", T.LongType()), T.StructField("__n", T.LongType()), T.StructField("__value", T.ArrayType(T.LongType()))])

    def run(batches):
        for b in batches:
            at = b.column(0).to_numpy()
            rows = np.flatnonzero(bitmap.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
            if not len(rows):
                continue
            ids = b.column(1).take(rows)
            for lo, hi, buf, offs in C.text_slices(b.column(2).take(rows)):
                g, d = shingle_sets(buf, offs, shingle)
                name, size = _names(g, d, hi - lo)
                ends = np.cumsum(size)
                if sketch:
                    value = parities(g, d, hi - lo)
                else:
                    value = [g[z - n : z].view(np.int64) for z, n in zip(ends, size)]
                yield C.arrow_rows(schema, **{id_col: ids.slice(lo, hi - lo), "__name": name, "__n": size, "__value": list(value)})

    return docs.where(F.col(id_col).isNotNull()).select(slot.alias("__slot"), id_col, text_col).mapInArrow(C.tidy(run), schema)


def parities(g: np.ndarray, d: np.ndarray, n_docs: int) -> np.ndarray:
    """SKETCH bits for each set, flipped by its n-grams: two sketches differ in
    at most as many bits as the sets differ in n-grams."""
    out = np.zeros((n_docs, SKETCH // 64), np.uint64)
    for lo in range(0, n_docs, 512):
        own = (d >= lo) & (d < lo + 512)
        rows = min(512, n_docs - lo)
        odd = np.bincount((d[own] - lo) * SKETCH + (g[own] >> np.uint64(20)).astype(np.int64) % SKETCH, minlength=rows * SKETCH) & 1
        out[lo : lo + rows] = np.packbits(odd.astype(np.uint8).reshape(rows, SKETCH), axis=1, bitorder="little").view(np.uint64)
    return out.view(np.int64)


def _sketched(docs: DataFrame, classes: DataFrame, pairs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """Those of pairs (a, b; names) whose sketches are near enough: the last
    filter, on whole sets, by texts read again and narrow rows."""
    pairs = C.materialise(pairs.distinct(), "candidates")
    wanted = pairs.select(F.col("a").alias("__name")).unionByName(pairs.select(F.col("b").alias("__name"))).distinct()
    wanted = C.materialise(wanted.join(classes.select("__name", F.col("__first").alias(id_col)), "__name"), "wanted")
    found = _read_again(docs, wanted, id_col, text_col, shingle, True).join(wanted, ["__name", id_col], "left_semi").dropDuplicates(["__name"])
    found = C.materialise(found.select("__name", "__n", "__value"), "sketches")
    side = lambda k: found.select(F.col("__name").alias(k), F.col("__n").alias(f"{k}n"), F.col("__value").alias(f"{k}v"))
    apart = F.aggregate(F.zip_with("av", "bv", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(apart * (100 + percent) <= (F.col("an") + F.col("bn")) * (100 - percent)).select("a", "b")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """Those of pairs (a, b; names) whose whole sets are similar.

    A class's text is read again where its first row stands, and its set goes to
    the stars that it is in; a star is a b with STAR of its a at most, so a b of
    more pairs is copied. Sets are shuffled twice, and no star grows."""
    pairs = C.materialise(_sketched(docs, classes, pairs, id_col, text_col, shingle, percent), "near")
    often = pairs.groupBy("b").count().where(F.col("count") > STAR).select("b", F.ceil(F.col("count") / STAR).cast("int").alias("copies"))
    dealt = pairs.join(often, "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("copies", F.lit(1))).cast("int").alias("__copy"))
    places = dealt.select(F.col("a").alias("__name"), F.col("b").alias("__head"), "__copy").unionByName(dealt.select(F.col("b").alias("__name"), F.col("b").alias("__head"), "__copy").distinct())
    places = C.materialise(places.join(classes.select("__name", F.col("__first").alias(id_col)), "__name"), "places")
    whole = _read_again(docs, places, id_col, text_col, shingle, False)
    star = Window.partitionBy("__head", "__copy")  # STAR sets and their head
    both = whole.join(places, ["__name", id_col]).withColumn("__top", F.max(F.when(F.col("__name") == F.col("__head"), F.col("__value"))).over(star))
    shared = F.size(F.array_intersect("__value", "__top"))
    alike = shared * (100 + percent) >= percent * (F.size("__value") + F.size("__top"))
    return C.materialise(both.where((F.col("__name") != F.col("__head")) & alike).select(F.col("__name").alias("a"), F.col("__head").alias("b")).distinct(), "similar")


# ---------------------------------------------------------------- join
def _sided(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}{c}") for c in df.columns])


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 90) -> DataFrame:
    """n_shingles and component of every row.

    Words are runs without space and \\x09-\\x0D, A-Z lower-cased; a row's set has
    the distinct runs of `shingle` words, or the whole sequence of a shorter
    text. Two rows are linked if 100 * |intersection| >= percent * |union|.
    Returns id, n_shingles (the set's size) and component_id, the smallest id
    that links reach, the own one included.

    One row for each input row. Null texts and texts without words have an empty
    set, which is linked with nothing, not even another empty one. Rows of one
    id are one node; a row with a null id has a null component and links
    nothing. Ties do not occur: equal sets are one class. An empty table gives an
    empty result; other columns play no part, whatever their names. A text is
    read whole by one task. N-grams and sets are told apart by 64-bit hashes.
    """
    docs = docs.select(id_col, text_col)
    scanned = C.materialise(_scan(docs, id_col, text_col, shingle), "scanned")
    rows = scanned.where(F.col("__block").isNull()).select(id_col, "__name", "__n")
    named = rows.where(F.col(id_col).isNotNull() & (F.col("__n") > 0))
    classes = C.materialise(named.groupBy("__name").agg(F.min(id_col).alias("__first")), "classes")
    rarity = docs.sparkSession.sparkContext.broadcast(_rarity(scanned))
    posts = _postings(docs.where(F.col(id_col).isNotNull()), text_col, shingle, percent, rarity)
    # sets of like length: two similar ones are in one band or in neighbouring ones
    band = F.floor(F.log(F.col("spot").bitwiseAND(F.lit(_LOW)).cast("double")) / math.log(101.0 / percent)).cast("int")
    shared = C.materialise(_met(posts, percent).drop("salt").withColumn("band", band), "shared")
    heads = shared.groupBy("gram", "band").agg(F.min(F.struct("spot", "name", "later")).alias("h")).select("gram", "band", *[F.col(f"h.{c}").alias(f"h_{c}") for c in ("spot", "name", "later")])
    near = may_be_similar("", "h_", percent) & (F.col("name") != F.col("h_name"))
    stars = shared.join(heads, ["gram", "band"]).where(near).select(F.col("name").alias("a"), F.col("h_name").alias("b"))
    links = _verified(docs, classes, stars, id_col, text_col, shingle, percent)
    # an id with several texts ties their sets together
    ids = named.groupBy(id_col).agg(F.min("__name").alias("a"), F.max("__name").alias("b")).where("a != b").select(id_col, "a")
    links = links.unionByName(named.join(ids, id_col).select("a", F.col("__name").alias("b")))
    comps = connected_components(links)

    held = shared.join(comps.withColumnRenamed("node", "name"), "name", "left").withColumn("component", F.coalesce("component", "name"))
    held = C.materialise(held, "held")
    open_ = held.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("gram")
    held = C.materialise(held.join(open_, "gram", "left_semi"), "open")
    longer = held.withColumn("band", F.explode(F.array("band", F.col("band") - 1)))
    size = lambda s: F.struct(F.col(f"{s}spot").bitwiseAND(F.lit(_LOW)), F.col(f"{s}name"))
    meet = (F.col("l_gram") == F.col("r_gram")) & (F.col("l_band") == F.col("r_band")) & (F.col("l_component") != F.col("r_component")) & (size("l_") < size("r_"))
    rest = _sided(held, "l_").join(_sided(longer, "r_"), meet & may_be_similar("l_", "r_", percent)).select(F.col("l_name").alias("a"), F.col("r_name").alias("b"))
    more = _verified(docs, classes, rest, id_col, text_col, shingle, percent)
    if not more.isEmpty():
        comps = connected_components(links.unionByName(more))
    found = classes.join(comps.withColumnRenamed("node", "__name"), "__name", "left").select("__name", "__first", F.coalesce("component", "__name").alias("__root"))
    found = C.materialise(found, "roots")
    first = found.groupBy("__root").agg(F.min("__first").alias("component_id"))
    roots = found.join(first, "__root").select("__name", "component_id")
    out = rows.join(roots, "__name", "left")
    own = F.when(F.col("__n") > 0, F.col("component_id")).otherwise(F.col(id_col))
    return out.select(id_col, F.col("__n").alias("n_shingles"), F.when(F.col(id_col).isNotNull(), own).alias("component_id"))


#: Pairs that share an n-gram are counted; links spread the least id.
OP12_SQL = """
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents
), sets as (
    select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s from words
), grams as (
    select doc_id, len(s) as n, unnest(s) as gram from sets
), shared as (
    select x.doc_id as a, y.doc_id as b, x.n + y.n as sizes, count(*) as common
    from grams x join grams y on x.gram = y.gram and x.doc_id < y.doc_id and 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n) group by all
), links as (
    select a, b from shared where 100 * common >= 90 * (sizes - common)
), edges as (
    select a, b from links union all select b, a from links
), reach as (
    select doc_id as node, doc_id as least from sets
    union
    select e.b, r.least from reach r join edges e on e.a = r.node where r.least < e.b
)
select s.doc_id, len(s.s)::bigint as n_shingles, min(r.least)::bigint as component_id from sets s join reach r on r.node = s.doc_id group by s.doc_id, len(s.s)
"""


def op12_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Size and component of every document's set of 3-word n-grams."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(docs)
