"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pulsegrain.llm import merkle

ROWS = "doc_id bigint, source string, leaf string, present string, g string, pos bigint, digest string, id string"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def plain_tree(leaves: list[str]) -> tuple[str, list[list[tuple[int, str]]]]:
    """Root, and each leaf's (place, siblings) by level."""
    nodes, steps, under = leaves, [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        ups, unders = [], []
        for lo in range(0, len(nodes), 16):
            run = nodes[lo : lo + 16]
            ups.append(sha("".join(run)))
            unders.append([x for u in under[lo : lo + 16] for x in u])
            for i in range(len(run)):
                for x in under[lo + i]:
                    steps[x].append((i, "".join(run[:i] + run[i + 1 :])))
        nodes, under = ups, unders
    return nodes[0], steps


def plain_manifest(rows: list[tuple]) -> list[tuple]:
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, below = [], []
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        subroot, steps = plain_tree([r[2] for r in own])
        subroots.append(subroot)
        below.append((own, steps))
    root, above = plain_tree(subroots)
    out = []
    for (own, steps), subroot, top in zip(below, subroots, above):
        for r, s in zip(own, steps):
            node = r[3]
            for at, others in s + top:
                node = sha(others[: at * 64] + node + others[at * 64 :])
            out.append((r[0], r[2], subroot, root, sha("".join(o for _, o in s + top)), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("height", [1, 2, 3])
def test_against_a_plain_tree(spark, height):
    """Groups of several blocks, of one row, a null one, and over 16 of them."""
    rng = random.Random(height)
    rows = []
    for g, n in [(None, 3), ("", 1), ("hot", 600), ("é", 17), ("b", 16), *[(f"s{i}", rng.randint(1, 40)) for i in range(30)]]:
        for _ in range(n):
            i = rng.choice([None, rng.randrange(10**6)]) if rng.random() < 0.05 else rng.randrange(10**6)
            leaf = sha(f"{i}{g}{rng.random()}")
            rows.append((i, g, leaf, sha(leaf) if rng.random() < 0.2 else leaf))
    rows += rows[:2]
    df = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], ROWS).repartition(5)
    got = merkle.merkle_manifest(df, present_col="present", height=height, witness=height == 1)
    if height == 1:
        assert got.columns[-1] == "steps"
        for r in got.limit(50).collect():
            assert merkle.fold(r.leaf, [(s["at"], s["others"]) for s in r.steps]) == r.root
        got = got.drop("steps")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_manifest(rows)


def test_partial_witnesses():
    """After every append each row's witness leads to the open subtree that holds it."""
    tree, nodes = merkle.Appender(), []
    for i in range(700):
        nodes.append(tree.append(sha(str(i))))
        if i % 37 == 0:
            held = {x.digest for level in tree.open for x in level}
            assert all(merkle.fold(x.digest, merkle.partial_witness(x)) in held for x in nodes)
            assert all(len(level) < 16 for level in tree.open)
    root = tree.finish(merkle.levels_of(700)).digest
    assert root == plain_tree([sha(str(i)) for i in range(700)])[0]
    assert all(merkle.fold(x.digest, merkle.partial_witness(x)) == root for x in nodes)


def test_row_hash_and_odd_tables(spark):
    df = spark.createDataFrame([(1, "s", "é b"), (None, None, None)], "doc_id bigint, source string, text string")
    hashed = df.withColumn("leaf", merkle.row_hash([F.col("doc_id"), F.col("source"), F.col("text")]))
    want = {1: sha("1:11:s4:é b"), None: sha("---")}
    assert {r.doc_id: r.leaf for r in hashed.collect()} == want
    alone = merkle.merkle_manifest(hashed.where("doc_id = 1")).first()
    assert alone.root == alone.subroot == alone.leaf == alone.folded_root and alone.verified and alone.proof_sha256 == sha("")
    none = merkle.merkle_manifest(hashed.limit(0))
    assert none.count() == 0 and none.columns[0] == "doc_id"


def test_query(spark, sf_dir):
    """Only rows whose text tampering changes fail."""
    rows = merkle.op13_merkle_manifest(spark, sf_dir)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = {r.doc_id: r.verified for r in rows.collect()}
    assert got == {i: not (zlib.crc32(str(i).encode()) % 5 == 0 and t is not None and t.translate(fold) != t) for i, t in docs.items()}
    assert not all(got.values())
