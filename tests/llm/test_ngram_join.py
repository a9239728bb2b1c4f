"""The n-gram Jaccard join against all pairs."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa

from pulsegrain.llm import common, near_copies, ngram_join

DOCS = "doc_id bigint, text string, name string, gram string, component string"


def grams(text: str | None, n: int) -> set:
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def plain_components(rows: list[tuple], n: int, percent: int) -> list[tuple]:
    """(id, size of the set, least id that links reach) of every row."""
    sets = [(i, grams(t, n)) for i, t in rows]
    least = {i: i for i, _ in rows if i is not None}
    links = [(i, j) for (i, a), (j, b) in itertools.combinations([s for s in sets if s[0] is not None], 2) if i != j and a and b and 100 * len(a & b) >= percent * len(a | b)]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            m = min(least[i], least[j])
            changed |= least[i] != m or least[j] != m
            least[i] = least[j] = m
    return sorted(((i, len(s), least.get(i)) for i, s in sets), key=repr)


def texts_with_copies(rng: random.Random) -> list[str]:
    vocab = [f"w{i}" for i in range(400)]
    lines = [" ".join(rng.choices(vocab, k=12)) for _ in range(12)]
    out = []
    for _ in range(25):
        base = rng.choices(vocab, k=rng.choice([1, 2, 3, 8, 40, 120]))
        for _ in range(rng.randint(1, 5)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append(" ".join(w[: len(w) - rng.randint(0, len(w) // 8)]).title() if rng.random() < 0.2 else " ".join(w))
    # texts of common lines only: prefixes meet often, sets seldom agree
    return out + ["\n".join(rng.sample(lines, 6)) for _ in range(40)]


def have(df) -> list[tuple]:
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_links_and_components(spark):
    for seed, n, percent in ((1, 3, 90), (2, 2, 70)):
        rng = random.Random(seed)
        rows = list(enumerate(texts_with_copies(rng)))
        rng.shuffle(rows)
        df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS).repartition(3)
        assert have(ngram_join.jaccard_components(df, shingle=n, percent=percent)) == plain_components(rows, n, percent)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A B"), (6, "a b c"), (7, "long text of a few words"), (7, "long text of a few words"), (8, "one two three four five"), (9, "quite other words than these"), (9, "one two three four five"), (None, "a b"), (None, None), (10, "x " * 20_000)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS)
    assert have(ngram_join.jaccard_components(df)) == plain_components(rows, 3, 90)
    none = ngram_join.jaccard_components(df.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "n_shingles", "component_id"]


def test_a_large_group_of_near_copies(spark):
    """More members than a star's head meets at once, and no pair between all."""
    rng = random.Random(4)
    base = [f"v{i}" for i in range(150)]
    texts = [" ".join(base)] + [" ".join(base[:k] + [f"u{i}"] + base[k + 1 :]) for i in range(1200) for k in [rng.randrange(20, 130)]]
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], DOCS).repartition(4)
    got = ngram_join.jaccard_components(df)
    assert got.where("component_id = 0").count() == len(texts)


def test_filters_lose_no_pair():
    """The first n-gram that two similar sets share passes every filter."""
    rng = np.random.default_rng(3)
    for _ in range(400):
        percent = int(rng.choice([50, 70, 80, 90]))
        a = rng.choice(10**6, int(rng.integers(1, 60)), replace=False)
        b = np.unique(np.concatenate([rng.choice(a, int(len(a) * rng.uniform(0.5, 1)) or 1, replace=False), rng.integers(0, 10**6, int(rng.integers(0, 8)))]))
        a = np.sort(a)
        common_ = np.intersect1d(a, b)
        if not len(common_) or 100 * len(common_) < percent * len(np.union1d(a, b)):
            continue
        pa_, pb = int(np.searchsorted(a, common_[0])), int(np.searchsorted(b, common_[0]))
        assert pa_ < ngram_join.prefix_size(np.array([len(a)]), percent)[0] and pb < ngram_join.prefix_size(np.array([len(b)]), percent)[0]
        both = len(a) + len(b)
        assert min(len(a) - pa_, len(b) - pb) * (100 + percent) >= percent * both
        part = lambda x: np.bincount(common.mix(x.astype(np.uint64)) >> np.uint64(61), minlength=8)
        apart = pa_ + pb + int(np.abs(part(a[pa_ + 1 :]) - part(b[pb + 1 :])).sum())
        assert apart * (100 + percent) <= both * (100 - percent)


def test_sketches_differ_as_sets_do():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(0, 900))).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * rng.uniform(0.5, 1))], rng.integers(0, 2**63, int(rng.integers(0, 90))).astype(np.uint64)]))
        s = ngram_join.parities(np.concatenate([a, b]), np.repeat([0, 1030], [len(a), len(b)]), 1031)
        bits = np.unpackbits((s[0] ^ s[1030]).view(np.uint8)).sum()
        apart = len(np.setxor1d(a, b))
        assert bits <= apart and (int(bits) - apart) % 2 == 0 and not s[1:1030].any()


def test_postings_that_meet(spark):
    """Once each, if their n-gram has several classes, wherever batches end."""
    rng = random.Random(6)
    sized = lambda: (3 << 32) + rng.choice([10, 12, 20])
    spots = {name: sized() for name in range(40)}
    rows = [(g, name, spots[name], 2, 3 if g % 50 == 0 else 0) for g in range(3000) for name in rng.choices(range(40), k=rng.choice([1, 1, 2, 5]))]
    rows += rows[:500]
    df = spark.createDataFrame(rows, ngram_join._POSTING).repartition(6)
    of: dict = {}
    for r in set(rows):
        of.setdefault(r[0], []).append(r[2] & 0xFFFFFFFF)
    near = lambda a, b: 100 * min(a, b) >= 80 * max(a, b)
    want = {r for r in set(rows) if r[4] or sum(near(r[2] & 0xFFFFFFFF, n) for n in of[r[0]]) > 1}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 7, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = [tuple(r) for r in ngram_join._met(df, 80).collect()]
            assert len(got) == len(set(got)) and set(got) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_later_counts_and_rarity(spark):
    texts = ["a b c d e f", "x y z", "a b c d e g h"]
    _, _, buf, offs = next(common.text_slices(pa.array(texts)))
    g, d = near_copies.shingle_sets(buf, offs, 3)
    size = np.bincount(d)
    part = (common.mix(g) >> np.uint64(61)).astype(np.int64)
    s = ngram_join.later_counts(part, d, size, np.ones(len(g), bool))
    for i in range(len(g)):
        later = [part[j] for j in range(i + 1, len(g)) if d[j] == d[i]]
        assert [(int(s[i]) >> (8 * k)) & 0xFF for k in range(8)] == np.bincount(np.array(later, int), minlength=8).tolist()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id bigint, text string").repartition(3)
    rarity = ngram_join._rarity(ngram_join._scan(df, "doc_id", "text", 3))
    shared = np.isin(g, [x for x in g if (g == x).sum() > 1])
    assert rarity[ngram_join._slots(g[shared])].min() > rarity[ngram_join._slots(g[~shared])].max()
    assert (rarity > 0).sum() == len(set(ngram_join._slots(g).tolist()))


