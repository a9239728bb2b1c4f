"""Near copies by exact word-shingle similarity (Jaccard): the form of operator 3
for similarities that fingerprints of 64 bits cannot tell.

The sets' SimHash fingerprints are linked by pigeonring chains as in operator 3;
these are the first candidates. What they leave is found by prefixes. Two sets of at least p percent similarity share one of their first shingles in
any common order, if each shows its first n - ceil(p n / 100) + 1. Candidates
come from those prefixes, common shingles last, and are thinned by bounds that
lose no pair: the sizes, the places of the shared shingle, and pigeonring chains
over sketches of the sets. A sketch has the parities of hashed counts, so two
sketches differ in at most as many bits as the sets differ in shingles; chains
of its segments must stay within their shares of that budget before the full
Hamming check. What is left is checked on the whole sets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import common as C
from .components import connected_components
from .pigeonring import hamming_links, has_chain

#: One text of so many is read for the order of shingles (no result hangs on it).
SAMPLED = 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BITMAP = 1 << 22
_PARITY = 4


def shingle_sets(buf: np.ndarray, offs: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the distinct word shingles of a slice's texts, by text,
    then hash. A text of fewer words is one shingle; one without words has none."""
    buf = _LOWER[buf]
    starts, ends, first = C.word_bounds(buf, offs)
    words, size = C.span_hashes(buf, starts, ends), np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)
    inside = C.runs_within(first, shingle)
    grams, docs = [C.gram_hashes(words, shingle)[inside]], [doc[: len(inside)][inside]]
    for k in range(1, shingle):
        short = np.flatnonzero(size == k)
        if len(short):
            grams.append(C.gram_hashes(words, k)[first[short]])
            docs.append(short)
    g, d = np.concatenate(grams), np.concatenate(docs)
    order = np.lexsort((g, d))
    g, d = g[order], d[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    return g[new], d[new]


def _names(g: np.ndarray, d: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, size) of each text's set; equal sets have equal names."""
    size = np.bincount(d, minlength=n_docs)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(C.mix(g ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    ends = np.cumsum(size)
    return C.mix(total[ends] - total[ends - size] + size.astype(np.uint64)).view(np.int64), size


def set_fingerprints(g: np.ndarray, size: np.ndarray) -> np.ndarray:
    """SimHash of each set, as a long: a bit is 1 if over half the set's hashes
    have it. g: the hashes, set after set."""
    total, doc = np.zeros((len(size), 64), np.int64), np.repeat(np.arange(len(size)), size)
    for lo in range(0, len(g), 1 << 16):
        own = doc[lo : lo + (1 << 16)]
        head = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        bits = np.unpackbits(g[lo : lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total[own[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int64)
    return np.packbits(2 * total > size[:, None], axis=1, bitorder="little").view(np.int64)[:, 0]


def _sets(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, name, n, fingerprint, parity words) of every row."""
    parities = [T.StructField(f"q{i}", T.LongType()) for i in range(_PARITY)]
    schema = T.StructType([docs.schema[id_col], T.StructField("__name", T.LongType()), T.StructField("__n", T.LongType()), T.StructField("__fp", T.LongType()), *parities])

    def run(batches):
        for b in batches:
            for lo, hi, buf, offs in C.text_slices(b.column(1)):
                g, d = shingle_sets(buf, offs, shingle)
                name, size = _names(g, d, hi - lo)
                bits = 64 * _PARITY
                odd = (np.bincount(d * bits + (g >> np.uint64(20)).astype(np.int64) % bits, minlength=(hi - lo) * bits) & 1).astype(np.uint8)
                q = np.packbits(odd.reshape(hi - lo, bits), axis=1, bitorder="little").view(np.int64)
                yield C.arrow_rows(schema, **{id_col: b.column(0).slice(lo, hi - lo), "__name": name, "__n": size, "__fp": set_fingerprints(g, size), **{f"q{i}": np.ascontiguousarray(q[:, i]) for i in range(_PARITY)}})

    return docs.select(id_col, text_col).mapInArrow(C.tidy(run), schema)


def _common_shingles(docs: DataFrame, id_col: str, text_col: str, shingle: int, most: int = 1_000_000) -> C.HashIndex:
    """Shingles of several sampled texts. They stand last in prefixes; which
    they are changes the work only, so the number kept is bounded."""
    schema = T.StructType([T.StructField("gram", T.LongType())])

    def run(batches):
        for b in batches:
            for _, _, buf, offs in C.text_slices(b.column(0)):
                yield C.arrow_rows(schema, gram=shingle_sets(buf, offs, shingle)[0].view(np.int64))

    part = docs.where(F.pmod(F.xxhash64(id_col), F.lit(SAMPLED)) == 0).select(text_col)
    often = part.mapInArrow(C.tidy(run), schema).groupBy("gram").count().where("count >= 4").orderBy(F.desc("count"), "gram").limit(most)
    return C.HashIndex(often.select("gram").toArrow().column(0).to_numpy().view(np.uint64))


def _prefixes(docs: DataFrame, text_col: str, shingle: int, percent: int, common) -> DataFrame:
    """(gram, name, spot) of every set's prefix; spot is the place in the set's
    order times 2**32 plus the set's size. Equal sets give equal rows."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("gram", "name", "spot")])

    def run(batches):
        for b in batches:
            for lo, hi, buf, offs in C.text_slices(b.column(0)):
                g, d = shingle_sets(buf, offs, shingle)
                name, size = _names(g, d, hi - lo)
                # equal sets of a slice are shown once
                new = np.zeros(hi - lo, bool)
                new[np.unique(name, return_index=True)[1]] = True
                order = np.lexsort((g, common.value.find(g) >= 0, d))
                g, d = g[order], d[order]
                place = np.arange(len(g)) - (np.cumsum(size) - size)[d]
                shown = (place < (size - (percent * size + 99) // 100 + 1)[d]) & new[d]
                yield C.arrow_rows(schema, gram=g[shown].view(np.int64), name=name[d[shown]], spot=(place[shown] << 32) + size[d[shown]])

    return docs.select(text_col).mapInArrow(C.tidy(run), schema)


def _sketched(classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b; names) whose sketches are near enough, and how many
    bits they differ in: pigeonring chains of 32-bit segments first, then all."""
    facts = ["__name", "__n", *[f"q{i}" for i in range(_PARITY)]]
    side = lambda k: classes.select(*[F.col(c).alias(f"{k}{c}") for c in facts])
    both = pairs.join(side("a"), F.col("a") == F.col("a__name")).join(side("b"), F.col("b") == F.col("b__name"))
    budget = F.floor((100 - percent) * (F.col("a__n") + F.col("b__n")) / (100 + percent))
    apart = [F.col(f"aq{i}").bitwiseXOR(F.col(f"bq{i}")) for i in range(_PARITY)]
    parts = [F.bit_count(x) for q in apart for x in (q.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(q, 32))]
    far = sum((F.bit_count(q) for q in apart), F.lit(0))
    return both.where(has_chain(parts, budget, 3)).where(far <= budget).select("a", "b", far.alias("far"))


def _fingerprint_pairs(classes: DataFrame) -> DataFrame:
    """(a, b; names) that link the sets whose fingerprints differ in at most two
    bits; sets of one fingerprint are linked to one of them."""
    reps = C.materialise(classes.groupBy(F.col("__fp").alias("fp")).agg(F.min("__name").alias("node")), "fingerprints")
    same = classes.join(reps, F.col("__fp") == F.col("fp")).where(F.col("__name") != F.col("node")).select(F.col("__name").alias("a"), F.col("node").alias("b"))
    return hamming_links(reps).unionByName(same).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, heads: DataFrame | None = None) -> DataFrame:
    """Those of pairs (a, b; names) whose whole sets are similar; of the pairs
    `heads` only the one of each a whose sketches are nearest is taken."""
    pairs = _sketched(classes, pairs.distinct(), percent).select("a", "b")
    if heads is not None:
        nearest = _sketched(classes, heads.distinct(), percent).groupBy("a").agg(F.min_by("b", F.struct("far", "b")).alias("b"))
        pairs = pairs.unionByName(nearest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
    pairs = C.materialise(pairs.select("a", "b"), "candidates")
    wanted = pairs.select(F.col("a").alias("__name")).unionByName(pairs.select(F.col("b").alias("__name"))).distinct()
    ids = classes.join(wanted, "__name", "left_semi").select(F.col("__first").alias(id_col))
    slot = F.pmod(F.xxhash64(id_col), F.lit(_BITMAP))
    # a bitmap of fixed size says which texts to read again; a false hit costs time only
    hit = np.zeros(_BITMAP, bool)
    hit[ids.select(slot.alias("s")).distinct().toArrow().column(0).to_numpy()] = True
    bitmap = docs.sparkSession.sparkContext.broadcast(np.packbits(hit))
    schema = T.StructType([T.StructField("name", T.LongType()), T.StructField("grams", T.ArrayType(T.LongType()))])

    def run(batches):
        for b in batches:
            at = b.column(0).to_numpy()
            rows = np.flatnonzero(bitmap.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
            if not len(rows):
                continue
            for lo, hi, buf, offs in C.text_slices(b.column(1).take(rows)):
                g, d = shingle_sets(buf, offs, shingle)
                name, size = _names(g, d, hi - lo)
                at_ = np.unique(name, return_index=True)[1]
                ends = np.cumsum(size)
                yield C.arrow_rows(schema, name=name[at_], grams=[g[z - n : z].view(np.int64) for z, n in zip(ends[at_], size[at_])])

    whole = docs.where(F.col(id_col).isNotNull()).select(slot.alias("slot"), text_col).mapInArrow(C.tidy(run), schema).dropDuplicates(["name"])
    both = pairs.join(whole.select(F.col("name").alias("a"), F.col("grams").alias("x")), "a").join(whole.select(F.col("name").alias("b"), F.col("grams").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return C.materialise(both.where(shared * (100 + percent) >= percent * (F.size("x") + F.size("y"))).select("a", "b"), "similar")


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows: id and name of its set; roots: name and component_id)."""
    docs = docs.where(F.col(id_col).isNotNull())
    sets = C.materialise(_sets(docs, id_col, text_col, shingle), "sets")
    facts = ["__n", "__fp", *[f"q{i}" for i in range(_PARITY)]]
    classes = C.materialise(sets.groupBy("__name").agg(F.min(id_col).alias("__first"), *[F.min(c).alias(c) for c in facts]), "classes")
    common = docs.sparkSession.sparkContext.broadcast(_common_shingles(docs, id_col, text_col, shingle))
    posts = _prefixes(docs, text_col, shingle, percent, common)
    crowd = posts.groupBy("gram").agg(F.min("name").alias("x"), F.max("name").alias("y")).where("x != y").select("gram")
    # one shuffle by shingle serves the join, the distinct rows and the window
    shared = posts.join(crowd, "gram", "left_semi").distinct()
    head = F.min(F.struct("spot", "name")).over(Window.partitionBy("gram"))
    shared = C.materialise(shared.withColumns({"head": head["name"], "head_spot": head["spot"]}), "postings")

    def alike(x: str, y: str):
        """Bounds on the sizes, and on what can be shared from two spots on."""
        size = [F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)) for c in (x, y)]
        room = [n - F.shiftright(F.col(c), 32) for n, c in zip(size, (x, y))]
        return (100 * F.least(*size) >= percent * F.greatest(*size)) & (F.least(*room) * (100 + percent) >= percent * (size[0] + size[1]))

    stars = shared.where(F.col("name") != F.col("head")).where(alike("spot", "head_spot")).select(F.col("name").alias("a"), F.col("head").alias("b"))
    links = _verified(docs, classes, _fingerprint_pairs(classes), id_col, text_col, shingle, percent, heads=stars)
    # an id with several texts ties their sets together
    ids = sets.groupBy(id_col).agg(F.min("__name").alias("a"), F.max("__name").alias("b")).where("a != b").select(id_col, "a")
    links = links.unionByName(sets.join(ids, id_col).select("a", F.col("__name").alias("b")))
    comps = connected_components(links)

    held = shared.select("gram", "name", "spot").join(comps.withColumnRenamed("node", "name"), "name", "left").withColumn("component", F.coalesce("component", "name"))
    held = C.materialise(held, "held")
    open_ = held.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("gram")
    held = C.materialise(held.join(open_, "gram", "left_semi"), "open")
    apart = (F.col("l.gram") == F.col("r.gram")) & (F.col("l.name") < F.col("r.name")) & (F.col("l.component") != F.col("r.component"))
    rest = held.alias("l").join(held.alias("r"), apart & alike("l.spot", "r.spot")).select(F.col("l.name").alias("a"), F.col("r.name").alias("b"))
    more = _verified(docs, classes, rest, id_col, text_col, shingle, percent)
    if not more.isEmpty():
        comps = connected_components(links.unionByName(more))
    found = classes.select("__name", "__first").join(comps.withColumnRenamed("node", "__name"), "__name", "left")
    found = C.materialise(found.select("__name", "__first", F.coalesce("component", "__name").alias("__root")), "roots")
    first = found.groupBy("__root").agg(F.min("__first").alias("component_id"))
    return sets.select(id_col, "__name"), found.join(first, "__root").select("__name", "component_id")


def near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(id, component_id) of every id: the smallest id that links reach. Two
    texts are linked if the sets of their word shingles (ASCII case folded) have
    a Jaccard similarity of at least `percent`; texts without words are alike.
    Rows of one id are one node; rows with a null id are left out. Other columns
    play no part, whatever their names; an empty table gives an empty result; a
    text of any length is read whole by one task.

    Sets whose fingerprints are two bits apart or less are compared first. The
    sets of a prefix shingle are compared with the one that shows it earliest
    (which has the fewest shingles of its own), and each set is linked to the
    nearest of these; after that, only a shingle's sets of different components
    are still paired up. No pair that is similar but of different
    components is left out.
    """
    rows, roots = _components(docs, id_col, text_col, shingle, percent)
    return rows.join(roots, "__name").select(id_col, "component_id").distinct()


def near_copy_roots(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(id): the smallest id of each component. It comes from one row for each
    distinct set, so that many copies of a text never meet."""
    return _components(docs, id_col, text_col, shingle, percent)[1].select(F.col("component_id").alias(id_col)).distinct()
