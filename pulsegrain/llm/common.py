"""Shared helpers: scratch tables, bounded samples and vectorised text kernels.

The kernels work on a batch's UTF-8 buffer as one numpy array, so that words,
word hashes and n-gram hashes cost a few array passes and no Python per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..scratch import materialise, scratch_dir  # noqa: F401  for the operators

SLICE_BYTES = 1 << 20
#: Word separators: space and \x09-\x0D.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[9, 10, 11, 12, 13, 32]] = True


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of df has them (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df, to be broadcast if it has at most `rows` rows; a job counts so far."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def crc_bucket(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo `modulus`; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


#: crc32 in DuckDB's SQL: a table that its rule gives, folded over the bytes.
CRC_TABLE_SQL = """bits as (
    select i::bigint as i, i::bigint as v, 0 as k from range(256) t(i)
    union all
    select i, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from bits where k < 8
), crc as (
    select list(v order by i) as t from bits where k = 8
)"""


def crc_sql(text: str) -> str:
    """crc32 of an ASCII text, in a query that also reads crc."""
    return f"xor(list_reduce([4294967295::bigint] || list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint), lambda x, c: xor(x >> 8, t[(xor(x, c) & 255) + 1])), 4294967295)"


def stratified_sample(df: DataFrame, stratum: str, order_by: Column, per_stratum: int, strata: int = 1000) -> DataFrame:
    """At most `per_stratum` rows of each of the `strata` most frequent strata,
    those with the smallest hash. Strata are first thinned by a hash threshold
    computed from their counts, so that no window ever holds a large stratum."""
    share, h = fresh(df, "__share", "__h")
    counts = df.groupBy(F.col(stratum).alias("__of")).count().orderBy(F.desc("count"), "__of").limit(strata)
    counts = counts.select("__of", F.least(F.lit(1.0), (2.0 * per_stratum + 100.0) / F.col("count")).alias(share))
    thin = df.withColumn(h, F.pmod(order_by, F.lit(1_000_003)) / F.lit(1_000_003.0)).join(F.broadcast(counts), F.col(stratum).eqNullSafe(F.col("__of"))).where(F.col(h) <= F.col(share))
    w = Window.partitionBy(stratum).orderBy(h, *[c for c in df.columns if c != stratum][:1])
    return thin.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= per_stratum).select(*df.columns)


def tidy(run):
    """A mapInArrow function that hands free memory back when it ends: workers
    live on, and the next stage may need their executor's memory elsewhere."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


# ---------------------------------------------------------------- slices
def text_slices(col: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts, each run of
    max_bytes at most unless a single text is longer. Null texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    n = len(col)
    if n == 0:
        return
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and col.buffers()[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def word_bounds(buf: np.ndarray, offs: np.ndarray, separators: np.ndarray = SEPARATORS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and the total) of the words of a
    slice; a word ends with its text."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    word = ~separators[buf]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    finish = word.copy()
    finish[:-1] &= ~word[1:]
    inner = offs[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    begin[inner] = word[inner]
    finish[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, offs)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def cut_texts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans of a slice as strings; spans may overlap, and begin and
    end between characters."""
    sizes = ends - starts
    offs = np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf[ragged(starts, sizes)])))


# ---------------------------------------------------------------- hashing
_B, _C = np.uint64(0x9E3779B97F4A7C15 | 5), np.uint64(0xD6E8FEB86659FD93)
_TABLE = np.random.default_rng(7).integers(1, 2**64, 256, dtype=np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        inverse = pow(int(base), -1, 1 << 64)
        out = []
        for b in (int(base), inverse):
            a = np.full(n, b, np.uint64)
            a[0] = 1
            out.append(np.cumprod(a, dtype=np.uint64))
        have = _POWERS[int(base)] = (out[0], out[1])
        if n > 1 << 22:  # do not keep what one very long text needed
            del _POWERS[int(base)]
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, the same wherever the bytes stand."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(_B, len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_TABLE[buf] * power[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (runs across texts too)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(_C, len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=total[1:])
    return mix((total[n:] - total[:-n]) * inverse[:m])


def runs_within(first: np.ndarray, n: int) -> np.ndarray:
    """For each run of n words starting at a word, whether one text holds it."""
    total = int(first[-1])
    m = total - n + 1
    if m <= 0:
        return np.zeros(0, bool)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return doc[:m] == doc[n - 1 :]


class HashIndex:
    """Sorted 64-bit hashes with values, found through an index of their top
    bits; much faster than a binary search for each key."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = tuple(v[order] for v in values)
        self.shift = np.uint64(64 - max(1, int(np.ceil(np.log2(max(len(keys), 1) * 4 + 1)))))
        heads = (self.keys >> self.shift).astype(np.int64)
        self.index = np.searchsorted(heads, np.arange(1 << (64 - int(self.shift)))).astype(np.int32)
        self.steps = int(np.bincount(heads).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key among the sorted keys, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = self.index[(keys >> self.shift).astype(np.int64)]
        last = np.int32(len(self.keys) - 1)
        at = np.minimum(at, last)
        out = np.where(self.keys[at] == keys, at, np.int32(-1))
        left = np.flatnonzero(out < 0)
        at = at[left]
        for _ in range(1, self.steps):
            if not len(left):
                break
            at = np.minimum(at + np.int32(1), last)
            hit = self.keys[at] == keys[left]
            out[left[hit]] = at[hit]
            go = ~hit & (self.keys[at] < keys[left])
            left, at = left[go], at[go]
        return out


def id_schema(df: DataFrame, id_col: str) -> str:
    """The id column as DDL."""
    return f"`{id_col}` {df.schema[id_col].dataType.simpleString()}"


def arrow_rows(schema: T.StructType, **columns) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    s = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], (pa.Array, pa.ChunkedArray)) else columns[f.name].cast(f.type) for f in s], schema=s)
