"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids, long ones are cut, and the pieces are dealt by
hash into shards of bounded size. Each shard is packed by several islands of
solutions: a crossover injects whole well-filled bins of one parent into
another, drops the bins that hold the same pieces, and puts displaced pieces
back best fit first. Islands evolve as Spark tasks; between epochs each gets
the elites of the others of its shard. An island stops where no packing can
have fewer bins. The emptiest bin of every shard is opened again and its pieces
are packed with those of other shards, until one shard holds what is left.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import os
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

CAPACITY = 4096
#: Pieces in a shard on average, and the bins that a shard's tokens fill at least.
SHARD, SHARD_BINS = 4096, 16
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 2, 6, 5
#: Words whose ids a task remembers.
MEMORY = 400_000


# ---------------------------------------------------------------- token ids
#: Byte classes: blank, letter, mark, and what only the full tokenizer may read
#: (digits, the apostrophe, <, control bytes, most of what is not ASCII).
_BLANK, _LETTER, _MARK, _OTHER, _WORD = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = _LETTER
_CLASS[list(b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~")] = _MARK
_CLASS[C.SEPARATORS] = _BLANK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Of U+00C0 to U+017E, which have two bytes: no letters, or letters whose lower
#: case or normal form is not one letter of the same kind.
_UNUSUAL = "\u00D7\u00F7\u0130\u0131\u0149"


def _classes(buf: np.ndarray) -> np.ndarray:
    """Class of each byte; precomposed Latin letters are letters."""
    out = _CLASS[buf]
    lead = np.flatnonzero((buf >= 0xC3) & (buf <= 0xC5))
    lead = lead[lead + 1 < len(buf)]
    code = ((buf[lead].astype(np.int32) & 31) << 6) | (buf[lead + 1] & 63)
    fine = lead[~np.isin(code, [ord(c) for c in _UNUSUAL]) & (code != 0x17F)]
    out[fine] = out[fine + 1] = _LETTER
    return out


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 itself, the others from U+0100 on in their order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(rest)) for b in range(256)}


class WordIds:
    """Ids of texts by a tokenizer that never joins across blanks: each
    distinct unit is tokenized once and remembered.

    The full tokenizer spends most of its time on normalizing and splitting. A
    word of Latin letters and ASCII marks is read as its runs of letters, in
    lower case, and of marks, so these are units of their own and go straight
    to the vocabulary model; any other word is one unit for the full tokenizer.
    A trial on sample words decides whether this tokenizer allows that.
    """

    TRIAL = ("Ab", "the,", "\u00C9t\u00E9.", "stra\u00DFe!!", "one%%%", "###", "\u017Durnal", "|", "No-", "ONLY", "a,b.c", "x1")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.bytes = self.tokenizer.model, _byte_letters()
        self.clear()
        self.direct = True
        buf, offs = next(C.text_slices(pa.array(self.TRIAL)))[2:]
        ids, edge = self.slice_ids(buf, offs)
        self.direct = [ids[a:z].tolist() for a, z in zip(edge, edge[1:])] == self._full(list(self.TRIAL))
        self.clear()

    def clear(self) -> None:
        self.row: dict[int, int] = {}
        self.size, self.at, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0
        self.flat = np.zeros(1 << 18, np.uint32)

    def _full(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _direct(self, units: list[str]) -> list[list[int]]:
        out, tokenize = [], self.model.tokenize
        for text in units:
            if not text.isascii():
                text = text.lower().encode().decode("latin-1").translate(self.bytes)
            out.append([t.id for t in tokenize(text)])
        return out

    def _learn(self, hashes: list[int], units: list[str], plain: list[bool]) -> None:
        full = [u for u, p in zip(units, plain) if not p]
        parts = iter(self._direct([u for u, p in zip(units, plain) if p]))
        others = iter(self._full(full) if full else ())
        ids = [next(parts) if p else next(others) for p in plain]
        n = len(self.row)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(sizes.sum())
        while n + len(ids) > len(self.size):
            self.size, self.at = np.concatenate([self.size, self.size]), np.concatenate([self.at, self.at])
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])
        self.size[n : n + len(ids)] = sizes
        self.at[n : n + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + total] = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, total)
        self.used += total
        self.row.update(zip(hashes, range(n, n + len(ids))))

    def _units(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes as they are hashed, starts, ends, whether plain, first unit of
        each text and the total)."""
        starts, ends, first = C.word_bounds(buf, offs)
        if not self.direct or not len(starts):
            return buf, starts, ends, np.zeros(len(starts), bool), first
        kind = _classes(buf)
        other = np.concatenate([[0], np.cumsum(kind == _OTHER)])
        whole = np.flatnonzero(other[ends] > other[starts])
        if len(whole):
            size = ends[whole] - starts[whole]
            kind[np.repeat(starts[whole] - (np.cumsum(size) - size), size) + np.arange(size.sum())] = _WORD
        text = np.where(kind == _LETTER, _LOWER[buf], buf)
        change = np.ones(len(buf), bool)
        change[1:] = kind[1:] != kind[:-1]
        inner = offs[1:-1]
        change[inner[inner < len(buf)]] = True
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], len(buf))
        keep = kind[starts] != _BLANK
        starts, ends = starts[keep], ends[keep]
        return text, starts, ends, kind[starts] != _WORD, np.searchsorted(starts, offs)

    def slice_ids(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the slice's texts, where each text's begin and the total)."""
        text, starts, ends, plain, first = self._units(buf, offs)
        h = C.span_hashes(text, starts, ends) ^ plain.astype(np.uint64)
        hashes, at, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.row) + len(hashes) > MEMORY and len(self.row) > MEMORY // 2:
            self.clear()
        hashes = hashes.tolist()
        known = list(map(self.row.get, hashes))
        new = [i for i, r in enumerate(known) if r is None]
        if new:
            raw = text.tobytes()
            a, z, p = starts[at[new]].tolist(), ends[at[new]].tolist(), plain[at[new]].tolist()
            n = len(self.row)
            self._learn([hashes[i] for i in new], [raw[x:y].decode("utf-8", "replace") for x, y in zip(a, z)], p)
            for k, i in enumerate(new):
                known[i] = n + k
        rows = np.array(known, np.int64)[which]
        size = self.size[rows]
        edge = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.at[rows] - edge[:-1], size) + np.arange(edge[-1])]
        return ids, edge[first]


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> WordIds:
    """One for each worker process; its words are forgotten with each task."""
    return WordIds(path)


def token_pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """(id, piece, start, length, ids_crc32): the text's ids and end_id, cut
    into pieces of capacity tokens, the last one what is left."""
    schema = T.StructType([docs.schema[id_col], T.StructField("piece", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]])

    def run(batches):
        encoder = _encoder(tokenizer)
        for b in batches:
            for lo, hi, buf, offs in C.text_slices(b.column(1)):
                ids, edge = encoder.slice_ids(buf, offs)
                row, piece, start, length, crc = [], [], [], [], []
                for i in range(hi - lo):
                    own = np.append(ids[edge[i] : edge[i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, a in enumerate(range(0, len(own), capacity)):
                        part = own[a : a + capacity]
                        row.append(lo + i)
                        piece.append(k)
                        start.append(a)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                yield C.arrow_rows(schema, **{id_col: b.column(0).take(pa.array(row, pa.int64()))}, piece=piece, start=start, length=length, ids_crc32=crc)
        encoder.clear()

    return docs.select(id_col, text_col).mapInArrow(C.tidy(run), schema)


# ---------------------------------------------------------------- one island
Bins = list[list[int]]


def best_fit(bins: Bins, loose: list[int], size: list[int], capacity: int) -> Bins:
    """bins with the loose items put in, each where the least room is left."""
    room = sorted((capacity - sum(size[i] for i in b), k) for k, b in enumerate(bins))
    for i in loose:
        at = bisect.bisect_left(room, (size[i], -1))
        if at == len(room):
            bins.append([i])
            free, k = capacity, len(bins) - 1
        else:
            free, k = room.pop(at)
            bins[k].append(i)
        bisect.insort(room, (free - size[i], k))
    return bins


def _fitness(bins: Bins, size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (squares favour uneven fill)."""
    return -len(bins), sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(a: Bins, b: Bins, size: list[int], capacity: int, rng: random.Random) -> Bins:
    """A child of a with well-filled bins of b: bins of a that share items with
    them go, and their other items are put back largest first, best fit."""
    fill = sorted(range(len(b)), key=lambda k: -sum(size[i] for i in b[k]))
    top = fill[: max(1, len(fill) // 2)]
    n = max(1, min(len(top), rng.randint(1, max(1, len(b) // 4))))
    injected = [list(b[k]) for k in rng.sample(top, n)]
    taken = {i for x in injected for i in x}
    child, loose = injected, []
    for x in a:
        if taken.isdisjoint(x):
            child.append(list(x))
        else:
            loose += [i for i in x if i not in taken]
    return best_fit(child, sorted(loose, key=lambda i: (-size[i], i)), size, capacity)


def _mutate(bins: Bins, size: list[int], capacity: int, rng: random.Random) -> Bins:
    """The emptiest bin and a few others are emptied and their items put back."""
    order = sorted(range(len(bins)), key=lambda k: sum(size[i] for i in bins[k]))
    out = {order[0], *rng.sample(range(len(bins)), min(len(bins), 1 + len(bins) // 50))}
    loose = [i for k in out for i in bins[k]]
    return best_fit([list(b) for k, b in enumerate(bins) if k not in out], sorted(loose, key=lambda i: (-size[i], i)), size, capacity)


def evolve(size: list[int], capacity: int, elites: list[Bins], seed: int, population: int = POPULATION, generations: int = GENERATIONS) -> tuple[Bins, int]:
    """(best packing, generations run); stops at the least possible bins."""
    least = -(-sum(size) // capacity)
    rng = random.Random(seed)
    falling = sorted(range(len(size)), key=lambda i: (-size[i], i))
    people = [([list(b) for b in e], _fitness(e, size, capacity)) for e in elites]
    if not people:
        first = best_fit([], falling, size, capacity)
        people.append((first, _fitness(first, size, capacity)))
    people.sort(key=lambda p: p[1], reverse=True)
    while len(people) < population and len(people[0][0]) > least:
        noisy = sorted(falling, key=lambda i: -size[i] * (1 + 0.15 * rng.random()))
        own = best_fit([], noisy, size, capacity)
        people.append((own, _fitness(own, size, capacity)))
    people.sort(key=lambda p: p[1], reverse=True)
    turn = 0
    while turn < generations and len(people[0][0]) > least:
        turn += 1
        for _ in range(population):
            (a, fa), (b, fb) = rng.sample(people, 2) if len(people) > 1 else (people[0], people[0])
            child = crossover(a, b, size, capacity, rng)
            if rng.random() < 0.5:
                child = _mutate(child, size, capacity, rng)
            people.append((child, _fitness(child, size, capacity)))
        people.sort(key=lambda p: p[1], reverse=True)
        people = people[:population]
    return people[0][0], turn


def _bins(assign: np.ndarray) -> Bins:
    out: Bins = [[] for _ in range(int(assign.max()) + 1 if len(assign) else 0)]
    for i, k in enumerate(assign.tolist()):
        out[k].append(i)
    return [b for b in out if b]


# ---------------------------------------------------------------- islands
def evolve_islands(shards: DataFrame, *, capacity: int = CAPACITY, islands: int = ISLANDS, epochs: int = EPOCHS, generations: int = GENERATIONS, population: int = POPULATION, parts: int = 4096) -> DataFrame:
    """(shard, assign, loose, generations) of shards (shard long, sizes
    array<int>): each piece's bin, the emptiest bin, and how many generations
    the shard's islands ran."""
    schema = T.StructType([T.StructField("shard", T.LongType()), *[T.StructField(n, T.IntegerType()) for n in ("island", "bins", "loose", "generations")], T.StructField("fill", T.DoubleType()), T.StructField("assign", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                shard, island, epoch, before = (b.column(i)[r].as_py() for i in range(4))
                size = np.asarray(b.column(4)[r].values).tolist()
                elites = [_bins(np.asarray(e.values)) for e in b.column(5)[r].values] if b.column(5)[r].is_valid else []
                best, turns = evolve(size, capacity, elites, hash((shard, island, epoch)) & 0x7FFFFFFF, population, generations)
                assign = np.zeros(len(size), np.int32)
                for k, x in enumerate(best):
                    assign[x] = k
                bins, fill = _fitness(best, size, capacity)
                loose = min(range(len(best)), key=lambda k: (sum(size[i] for i in best[k]), k))
                yield C.arrow_rows(schema, shard=[shard], island=[island], bins=[-bins], loose=[loose], generations=[before + turns], fill=[fill], assign=pa.array([assign], pa.list_(pa.int32())))

    best = None
    for epoch in range(epochs):
        if best is None:
            tasks = shards.select("shard", "sizes", F.lit(0).alias("before"), F.lit(None).cast("array<array<int>>").alias("elites"))
        else:
            elites = best.groupBy("shard").agg(F.sum("generations").cast("int").alias("before"), F.transform(F.sort_array(F.collect_list(F.struct("island", "assign"))), lambda x: x["assign"]).alias("elites"))
            tasks = shards.join(elites, "shard")
        tasks = tasks.select("shard", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"), F.lit(epoch).alias("epoch"), "before", "sizes", "elites")
        # what was run before is counted on one island
        tasks = tasks.withColumn("before", F.when(F.col("island") == 0, F.col("before")).otherwise(0))
        best = C.materialise(tasks.repartition(parts, "shard", "island").mapInArrow(C.tidy(run), schema), "islands")
    first = F.struct(-F.col("bins"), F.col("fill"), -F.col("island"))
    return best.groupBy("shard").agg(F.max_by("assign", first).alias("assign"), F.max_by("loose", first).alias("loose"), F.sum("generations").alias("generations"))


def pack_pieces(pieces: DataFrame, *, capacity: int = CAPACITY, shard_size: int = SHARD, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """pieces (`length` among its columns, 1 to capacity) with sequence_id and
    offset; columns of these two names give way. Pieces of full length are
    sequences of their own. Equal rows are packed each; an empty table stays
    empty."""
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    pieces = pieces.select(*names)
    full = pieces.where(F.col("length") >= capacity).withColumn("sequence_id", -F.monotonically_increasing_id() - 1).withColumn("offset", F.lit(0).cast("long"))
    rest, placed, level = pieces.where(F.col("length") < capacity), None, 0
    last = None
    while last != 1:
        n, tokens = rest.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        last = n_shards = max(1, min(-(-n // shard_size), tokens // (capacity * SHARD_BINS)))
        # rows that are equal in every column are told apart by their place
        spread = rest.select(F.struct("length", *[n for n in names if n != "length"]).alias("piece"), F.monotonically_increasing_id().alias("at"))
        shard = F.pmod(F.xxhash64("piece", "at"), F.lit(n_shards)) if n_shards > 1 else F.lit(0).cast("long")
        items = C.materialise(spread.groupBy(shard.alias("shard")).agg(F.sort_array(F.collect_list("piece")).alias("items")), "shards")
        sizes = items.select("shard", F.transform("items", lambda x: x["length"].cast("int")).alias("sizes"))
        top = evolve_islands(sizes, capacity=capacity, islands=islands, epochs=epochs, parts=max(1, min(n_shards * islands, 4096)))
        out = items.join(top, "shard").select("shard", "loose", F.explode(F.arrays_zip("items", "assign")).alias("x"))
        out = C.materialise(out, "packed") if n_shards > 1 else out
        done = out.where("x.assign != loose") if n_shards > 1 else out
        done = done.select(((F.col("shard") * (1 << 20) + F.col("x.assign")) * 8 + F.lit(min(level, 7))).alias("sequence_id"), "x.items.*")
        placed = done if placed is None else placed.unionByName(done)
        rest, level = out.where("x.assign = loose").select("x.items.*"), level + 1
    from pyspark.sql.window import Window

    # a sequence has at most `capacity` pieces
    w = Window.partitionBy("sequence_id").orderBy("length", *names).rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("offset", F.sum("length").over(w) - F.col("length"))
    return placed.select(*names, "sequence_id", "offset").unionByName(full)


def pack_documents(docs: DataFrame, *, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and place.

    Returns id, piece, start, length, ids_crc32, sequence_id, offset. A null or
    empty text is the end token alone; a null id is packed like any other and
    repeated rows are packed each; a text of any length is cut. Other columns
    play no part, and an empty table gives no pieces. tokenizer:
    the file of a tokenizer that never joins across blanks; by default the
    installed word-level one.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = C.materialise(token_pieces(docs, str(tokenizer), id_col=id_col, text_col=text_col, capacity=capacity), "pieces")
    return pack_pieces(pieces, capacity=capacity)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
