"""Sampled sub-word segmentation: forward filtering, backward sampling.

A text is its bytes with one blank in front, cut before runs of blanks and
after runs of control bytes into units; no piece of the vocabulary spans such a cut, so
none is lost to the lattice. The lattice of a unit has an edge
for each vocabulary piece that matches it, and one of byte pieces for each
character that has no piece. Forward sums over the lattice give each place the
probability of every edge that ends there; a segmentation is drawn backwards
from the end. Draws are hashes of the row's key and the place in the text, so
they do not depend on batches, tasks or retries. Each distinct unit's lattice
is filtered once for a slice of texts, and all its occurrences draw from it.

Decoding joins the pieces' bytes and drops the blank in front: whatever was
drawn, the text comes back byte for byte.
"""

from __future__ import annotations

import functools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

SLICE = 1 << 20
DRAW_BITS = 40
_CONTROL = np.zeros(256, bool)
_CONTROL[:32] = True


@dataclass
class Pieces:
    """spans: hash of a piece's bytes -> (id, log weight); byte_ids of the 256
    byte pieces; raw: bytes of each id; longest: bytes of the longest piece."""

    spans: C.HashIndex
    byte_ids: np.ndarray
    raw: list[bytes]
    longest: int
    rare: float


@functools.lru_cache(maxsize=2)
def load_pieces(path: str) -> Pieces:
    """The vocabulary of a byte-fallback model. Its scores are merge ranks, so
    a piece weighs by Zipf's law: 1 / (rank + 2.7)."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    raw, byte_ids, ids, weight = [b""] * n, np.full(256, -1, np.int64), [], []
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            raw[i] = bytes([int(piece[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            raw[i] = piece.replace("▁", " ").encode()
            if b" " in raw[i].lstrip(b" ") or min(raw[i].rstrip(bytes(range(32))), default=32) < 32:
                raise ValueError(f"piece {i} spans a place where texts are cut")
            if raw[i]:
                ids.append(i)
                weight.append(-np.log(max(0.0, -sp.get_score(i)) + 2.7))
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary has no byte pieces")
    if max(len(raw[i]) for i in ids) > 63:
        raise ValueError("a piece is longer than 63 bytes")
    joined = np.frombuffer(b"".join(raw[i] for i in ids), np.uint8)
    ends = np.cumsum([len(raw[i]) for i in ids])
    h = C.span_hashes(joined, ends - [len(raw[i]) for i in ids], ends)
    return Pieces(C.HashIndex(h, np.array(ids), np.array(weight)), byte_ids, raw, max(len(raw[i]) for i in ids), -np.log(n + 2.7))


class Lattice:
    """Filtered lattices of the distinct units of a buffer. Nodes are places
    before and after each byte of each unit; edges lie by the node they end at."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces, alpha: float):
        size = ends - starts
        self.base = np.cumsum(size + 1) - size - 1
        self.end = self.base + size
        n = int(size.sum())
        flat = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(n)
        text = buf[flat]
        node = np.repeat(self.base - (np.cumsum(size) - size), size) + np.arange(n)  # before each byte
        room = np.repeat(np.cumsum(size), size) - np.arange(n)  # bytes to the unit's end
        lead = (text & 0xC0) != 0x80
        power, inverse = C._powers(C._B, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(C._TABLE[text] * power[:n], out=total[1:])
        begin = np.flatnonzero(lead)
        covered = np.zeros(n, bool)
        width = np.diff(np.append(begin, n))  # bytes of each character
        width = np.minimum(width, room[begin])
        char_of = np.zeros(n, np.int64)
        char_of[begin] = width
        src, dst, pid, wt = [], [], [], []
        at = begin
        for length in range(1, pieces.longest + 1):
            at = at[room[at] >= length]
            if not len(at):
                break
            stop = at + length
            whole = at[(room[at] == length) | lead[np.minimum(stop, n - 1)]]
            h = C.mix((total[whole + length] - total[whole]) * inverse[whole] + np.uint64(length))
            found = pieces.spans.find(h)
            ok = found >= 0
            whole, found = whole[ok], found[ok]
            src.append(node[whole])
            dst.append(node[whole] + length)
            pid.append(pieces.spans.values[0][found])
            wt.append(pieces.spans.values[1][found])
            covered[whole[char_of[whole] == length]] = True
        bare = begin[~covered[begin]]
        src.append(node[bare])
        dst.append(node[bare] + char_of[bare])
        pid.append(np.full(len(bare), -1))
        wt.append(char_of[bare] * pieces.rare)
        src, dst, pid, wt = (np.concatenate(x) for x in (src, dst, pid, wt))
        wt = wt * alpha

        nodes = n + len(size)
        place = np.zeros(nodes, np.int64)  # of a node in its unit
        place[node] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        place[self.end] = size
        # by place, node and falling length: a key that no two edges share, so
        # that an edge's neighbours do not depend on the slice
        order = np.argsort((place[dst] * nodes + dst) * 64 + 63 - (dst - src))
        src, dst, pid, wt = src[order], dst[order], pid[order], wt[order]
        step = place[dst]
        forward = np.full(nodes, -np.inf)
        forward[self.base] = 0.0
        score = np.empty(len(src))
        cut = np.flatnonzero(np.append(True, step[1:] != step[:-1]))
        for a, z in zip(cut, np.append(cut[1:], len(step))):
            c = forward[src[a:z]] + wt[a:z]
            head = np.flatnonzero(np.append(True, dst[a + 1 : z] != dst[a : z - 1]))
            top = np.maximum.reduceat(c, head)
            many = np.diff(np.append(head, z - a))
            e = np.exp(c - np.repeat(top, many))
            tot = np.add.reduceat(e, head)
            forward[dst[a:z][head]] = top + np.log(tot)
            score[a:z] = e / np.repeat(tot, many)
        # running sums of each node's edges, in whole 2**-DRAW_BITS so that they
        # are exact wherever the node stands
        self.src, self.pid, self.dst = src, pid, dst
        share = np.rint(score * float(1 << DRAW_BITS)).astype(np.int64)
        head = np.flatnonzero(np.append(True, dst[1:] != dst[:-1]))
        many = np.diff(np.append(head, len(dst)))
        run = np.cumsum(share)
        self.upto = run - np.repeat(run[head] - share[head], many)
        self.upto[head + many - 1] = 1 << (DRAW_BITS + 1)
        self.first = np.zeros(nodes, np.int64)
        self.first[dst[head]] = head


def _draws(seeds: np.ndarray, place: np.ndarray) -> np.ndarray:
    h = C.mix(seeds + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (h >> np.uint64(64 - DRAW_BITS)).astype(np.int64)


def sample_slice(buf: np.ndarray, offs: np.ndarray, seeds: np.ndarray, pieces: Pieces, alpha: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts of a slice, where each text's begin and the total);
    seeds: one 64-bit number for each text."""
    n_docs = len(offs) - 1
    size = np.diff(offs)
    some = (size > 0).astype(np.int64)
    begin = offs[:-1] + np.cumsum(some) - some  # of each text, with its blank
    wide = np.full(len(buf) + int(some.sum()), 32, np.uint8)
    doc = np.repeat(np.arange(n_docs), size)
    wide[np.arange(len(buf)) + np.cumsum(some)[doc]] = buf
    if not len(wide):
        return np.zeros(0, np.int64), np.zeros(n_docs + 1, np.int64)
    control = _CONTROL[wide]
    blank = wide == 32
    opens = blank.copy()
    opens[1:] &= ~(blank[1:] & blank[:-1])
    opens[1:] |= control[:-1] & ~control[1:]
    opens[begin[size > 0]] = True
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(wide))
    _, at, which = np.unique(C.span_hashes(wide, starts, ends), return_index=True, return_inverse=True)
    lattice = Lattice(wide, starts[at], ends[at], pieces, alpha)
    unit_doc = np.repeat(np.arange(n_docs), size + some)[starts]
    seed, origin = seeds[unit_doc], starts - begin[unit_doc]
    units = np.arange(len(starts))
    now, base = lattice.end[which], lattice.base[which]
    chosen, owner, turn = [], [], 0
    turns = np.zeros(len(starts), np.int64)
    live = units
    while len(live):
        u = _draws(seed[live], origin[live] + now[live] - base[live])
        edge = lattice.first[now[live]]
        left = np.flatnonzero(u >= lattice.upto[edge])
        while len(left):
            edge[left] += 1
            left = left[u[left] >= lattice.upto[edge[left]]]
        chosen.append(edge)
        owner.append(live)
        now[live] = lattice.src[edge]
        turns[live] += 1
        turn += 1
        live = live[now[live] != base[live]]
    # drawn from the end: a unit's k-th draw is its k-th last edge
    offset = np.cumsum(turns) - turns
    edges = np.zeros(int(turns.sum()), np.int64)
    of_unit = np.repeat(units, turns)
    for k, (e, o) in enumerate(zip(chosen, owner)):
        edges[offset[o] + turns[o] - 1 - k] = e
    pid = lattice.pid[edges]
    bare = pid < 0
    times = np.where(bare, lattice.dst[edges] - lattice.src[edges], 1)
    ids = np.repeat(pid, times)
    where = np.flatnonzero(bare)
    if len(where):
        to = np.repeat((np.cumsum(times) - times)[where], times[where])
        inner = np.arange(len(to)) - np.repeat(np.cumsum(times[where]) - times[where], times[where])
        # bytes of the unit's own occurrence
        source = np.repeat(starts[of_unit[where]] + lattice.src[edges[where]] - lattice.base[which[of_unit[where]]], times[where]) + inner
        ids[to + inner] = pieces.byte_ids[wide[source]]
    per_doc = np.bincount(unit_doc[of_unit], weights=times, minlength=n_docs).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(per_doc)])


def decode_ids(ids, pieces: Pieces) -> str:
    """The text of a list of ids."""
    raw = b"".join([pieces.raw[i] for i in ids])
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def row_seeds(id_col: str, seed: int):
    """A 64-bit number for each row from its key."""
    return F.xxhash64(F.lit(seed), F.col(id_col))


def _path(model: str | None) -> str:
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    return str(model)


def _sampled(batches, path: str, alpha: float):
    """(batch, first row, end row, ids, edges) over batches of (id, seed, text)."""
    pieces = load_pieces(path)
    for b in batches:
        seeds = b.column(1).to_numpy().view(np.uint64)
        for lo, hi, buf, offs in C.text_slices(b.column(2), SLICE):
            ids, edge = sample_slice(buf, offs, seeds[lo:hi], pieces, alpha)
            yield b, lo, hi, ids, edge, pieces


def encode_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """id and piece_ids (array of int) of every text, one sampled segmentation
    each. alpha sharpens the weights (0: all segmentations alike; large: the
    likeliest). Null and empty texts have no pieces. Rows with one key and text
    get one segmentation; a null key counts as a key. model: the file of a
    vocabulary with byte pieces, by default the installed one. One row for each
    input row; an empty table gives an empty result; other columns play no part,
    whatever their names. A text of any length is read whole by one task, whose
    lattices are those of its units."""
    path = _path(model)
    schema = T.StructType([docs.schema[id_col], T.StructField("piece_ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for b, lo, hi, ids, edge, _ in _sampled(batches, path, alpha):
            lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield C.arrow_rows(schema, **{id_col: b.column(0).slice(lo, hi - lo)}, piece_ids=lists)

    return docs.select(id_col, row_seeds(id_col, seed), text_col).mapInArrow(C.tidy(run), schema)


def decode_pieces(encoded: DataFrame, *, id_col: str = "doc_id", ids_col: str = "piece_ids", model: str | None = None) -> DataFrame:
    """id and text of every row of ids; null ids are an empty text. One row for
    each input row, repeated ones alike; an empty table gives an empty result;
    other columns play no part, whatever their names."""
    path = _path(model)
    schema = T.StructType([encoded.schema[id_col], T.StructField("text", T.StringType())])

    def run(batches):
        pieces = load_pieces(path)
        for b in batches:
            yield C.arrow_rows(schema, **{id_col: b.column(0)}, text=[decode_ids(x.as_py() or [], pieces) for x in b.column(1)])

    return encoded.select(id_col, ids_col).mapInArrow(C.tidy(run), schema)


def piece_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit numbers) and
    lossless: whether the decoded ids are the text, byte for byte. Nulls, repeated
    rows, empty tables, extra columns and long texts as in encode_pieces."""
    path = _path(model)
    schema = T.StructType([docs.schema[id_col], T.StructField("n_pieces", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("lossless", T.BooleanType())])

    def run(batches):
        for b, lo, hi, ids, edge, pieces in _sampled(batches, path, alpha):
            crc, same = [], []
            texts = b.column(2).slice(lo, hi - lo)
            small, listed = ids.astype("<u4"), ids.tolist()
            for i, text in enumerate(texts):
                a, z = int(edge[i]), int(edge[i + 1])
                crc.append(zlib.crc32(small[a:z].tobytes()))
                same.append(decode_ids(listed[a:z], pieces) == (text.as_py() or ""))
            yield C.arrow_rows(schema, **{id_col: b.column(0).slice(lo, hi - lo)}, n_pieces=np.diff(edge), ids_crc32=crc, lossless=same)

    return docs.select(id_col, row_seeds(id_col, seed), text_col).mapInArrow(C.tidy(run), schema)


def op9_piece_sampling(spark, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, and whether it decodes to it."""
    return piece_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
