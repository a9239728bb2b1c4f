"""Periodic runs against plain loops."""

from __future__ import annotations

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from pulsegrain.llm import common, periodic_runs

DOCS = "doc_id bigint, text string, runs string, collapsed string, start bigint"


def plain_runs(w: list[str], least: int, powers: int) -> list[tuple[int, int, int]]:
    """(start, length, period), period by period; a multiple finds the same words."""
    out: dict = {}
    for p in range(1, len(w) // powers + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i > s and i - s + p >= max(least, powers * p):
                out.setdefault((s, i - s + p), p)
            i += i == s
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng: random.Random, n: int) -> str:
    words: list[str] = []
    while len(words) < n:
        unit = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 9))]
        words += (unit * rng.randint(1, 9))[: rng.randint(1, 60)]
    return " ".join(words)


def digests(doc_id: int, text: str | None) -> tuple:
    w = (text or "").split()
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w, 6, 4)
    gone = {i for s, size, p in runs for i in range(s + p, s + size)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *top, sha("".join(f"{s},{size},{p}\n" for s, size, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))


def test_runs_of_small_alphabets():
    rng = random.Random(3)
    for _ in range(60):
        texts = [repetitive(rng, rng.choice([0, 3, 30, 150])) for _ in range(5)]
        for least, powers in ((6, 4), (2, 2), (5, 3), (12, 2)):
            got = []
            for lo, _, buf, offs in common.text_slices(pa.array(texts), rng.choice([1, 1 << 20])):
                starts, ends, first = common.word_bounds(buf, offs)
                got += [(lo + r[0], *r[1:]) for r in periodic_runs.slice_runs(buf, starts, ends, first, least, powers).tolist()]
            assert got == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t.split(), least, powers)]


def test_every_suffix_pair_is_walked_once():
    """A run of k words of one period gives one pair for each multiple that fits."""
    ids = list(range(5)) * 8
    pairs = [(i, n, p) for i, n, p in periodic_runs.maximal_pairs([i for i in range(35, -1, -5)], [0, 5, 10, 15, 20, 25, 30, 35], {i: -1 if i == 0 else 4 for i in range(0, 40, 5)}, 6, 4)]
    assert sorted(pairs) == [(0, 40, 5), (0, 40, 10)]
    assert len(ids) == 40


def test_long_texts():
    rng = random.Random(5)
    unit = [str(rng.randint(0, 40)) for _ in range(9_000)]
    for text, want in (("a " * 60_000, [[0, 0, 60_000, 1]]), (" ".join(unit * 5), [[0, 0, 45_000, 9_000]])):
        _, _, buf, offs = next(common.text_slices(pa.array([text])))
        starts, ends, first = common.word_bounds(buf, offs)
        assert periodic_runs.slice_runs(buf, starts, ends, first, 6, 4).tolist() == want


def test_query_columns(spark):
    rng = random.Random(9)
    texts = [None, "", " \n\t ", "x", "a a a a a a", "a a a a a", " b\tb  b\nb b b b ", "Ünï çödé " * 5, "A a " * 9] + [repetitive(rng, 80) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, "a a a a a a")]
    df = spark.createDataFrame([(i, t, "x", "y", 5) for i, t in rows], DOCS).repartition(3)
    out = periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.with_planted_tails(df)))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted((digests(i, t) for i, t in rows), key=repr)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "z z z z z z z q", "x", "y", 1), (1, None, None, None, None)], DOCS)
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(df).collect()}
    assert [tuple(x) for x in got[None].runs] == [(0, 7, 1)] and got[None].collapsed == "z q"
    assert got[1].runs == [] and got[1].collapsed == ""
    none = periodic_runs.periodic_runs(df.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "runs", "collapsed"]
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(df, powers=1)
