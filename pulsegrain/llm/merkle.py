"""Merkle manifest of a dataset, with a witness for every row.

Rows are leaves, hashed where they are read. The leaves of a group, in order,
are appended one after another to a tree of fixed arity that is kept as its open
subtrees only. A row's witness starts empty; whenever the siblings of a subtree
that holds it are complete, that subtree learns them, which extends the
witnesses of all its rows at once. Blocks of ARITY ** HEIGHT rows are aligned
with the tree, so that tasks append them apart; their roots are then appended
like leaves of a further tree, again in blocks, until one is left for each group,
and the groups' roots in turn. Witnesses come down the same way: a block's own
part, then that of its root. No task holds more than a block and no group is
ranked in one task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import common as C

#: A block has ARITY ** HEIGHT rows.
ARITY, HEIGHT = 16, 3
_STEPS = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("others", T.StringType())]))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Node:
    """A subtree; `at`, `others` and `parent` come with its last sibling."""

    __slots__ = ("digest", "at", "others", "parent")

    def __init__(self, value: str):
        self.digest, self.parent = value, None


class Appender:
    """The open subtrees of a sequence that grows: at each level the nodes that
    wait for their siblings."""

    def __init__(self, arity: int = ARITY):
        self.arity, self.open = arity, [[]]

    def append(self, value: str) -> Node:
        node = Node(value)
        self._put(0, node)
        return node

    def _put(self, level: int, node: Node) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        text = "".join(x.digest for x in run)
        parent, at = Node(digest(text)), 0
        for i, x in enumerate(run):
            size = len(x.digest)
            x.at, x.others, x.parent = i, text[:at] + text[at + size :], parent
            at += size
        self._put(level + 1, parent)

    def finish(self, levels: int) -> Node:
        """Complete what is open below `levels`; the root."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        return self.open[levels][0]


def partial_witness(node: Node) -> list[tuple[int, str]]:
    """(place among its siblings, the siblings) of each complete level, upwards."""
    out = []
    while node.parent is not None:
        out.append((node.at, node.others))
        node = node.parent
    return out


def fold(value: str, witness: list[tuple[int, str]]) -> str:
    """The root that a leaf has with a witness."""
    for at, others in witness:
        cut = at * 64
        value = digest(others[:cut] + value + others[cut:])
    return value


def levels_of(n: int, arity: int = ARITY) -> int:
    """Levels until one node is left."""
    out = 0
    while n > 1:
        n, out = -(-n // arity), out + 1
    return out


# ---------------------------------------------------------------- leaves
def row_hash(columns: list[Column]) -> Column:
    """sha256 of the fields, each '-' if null, else its bytes' count, ':' and value."""
    fields = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in columns]
    return F.sha2(F.concat(*fields), 256)


def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """df with pos (place within the group, from 0) and n (the group's rows).
    Ranges of (group, order) are counted apart; a group's offsets come from the
    counts of its ranges, which are as many as the tasks it spans."""
    df = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("local", T.LongType())])
    at = df.columns.index(group)

    def number(batches):
        from pyspark import TaskContext

        part, last, n = TaskContext.get().partitionId(), None, -1
        for b in batches:
            local = []
            for g in b.column(at).to_pylist():
                n = n + 1 if n >= 0 and g == last else 0
                last = g
                local.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * len(local), pa.int32()), pa.array(local, pa.int64())], names=[*b.schema.names, "part", "local"])

    numbered = C.materialise(df.mapInArrow(C.tidy(number), schema), "numbered")
    counts = numbered.groupBy(group, "part").count()
    own = Window.partitionBy(group)
    before = F.sum("count").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col(group).alias("__g"), F.col("part").alias("__p"), F.coalesce(before, F.lit(0)).alias("before"), F.sum("count").over(own).alias("n"))
    # a part has its share of the rows, so the join meets no hot key
    out = numbered.join(offsets, (F.col("part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")))
    return out.withColumn("pos", F.col("local") + F.col("before")).drop("part", "local", "before", "__g", "__p")


# ---------------------------------------------------------------- blocks
def _dealt(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {ARITY**height}"))


def _block_roots(nodes: DataFrame, height: int) -> DataFrame:
    """nodes: g, pos, n, digest. The blocks' roots as nodes of the next tree."""
    schema = T.StructType([nodes.schema["g"], *[T.StructField(c, T.LongType()) for c in ("pos", "n")], T.StructField("digest", T.StringType())])

    def build(batches):
        key, tree, size, out = None, None, 0, []

        def close():
            out.append((*key, -(-size // ARITY**height), tree.finish(min(height, levels_of(size))).digest))

        for b in batches:
            for g, block, n, value in zip(*[c.to_pylist() for c in b.columns]):
                if tree is None or (g, block) != key:
                    if tree is not None:
                        close()
                    key, tree, size = (g, block), Appender(), n
                tree.append(value)
            yield C.arrow_rows(schema, **dict(zip(schema.names, map(list, zip(*out)))) if out else {c: [] for c in schema.names})
            out = []
        if tree is not None:
            close()
            yield C.arrow_rows(schema, **dict(zip(schema.names, map(list, zip(*out)))))

    dealt = _dealt(nodes, height).repartition("g", "block").sortWithinPartitions("g", "block", "pos")
    return dealt.select("g", "block", "n", "digest").mapInArrow(C.tidy(build), schema)


def _towers(nodes: DataFrame, height: int, label: str) -> list[DataFrame]:
    """The nodes, their block roots, the block roots of these and so on, until
    every group has one."""
    tables = [nodes]
    while (tables[-1].agg(F.max("n")).first()[0] or 0) > 1:
        tables.append(C.materialise(_block_roots(tables[-1], height), label))
    return tables


def _descend(nodes: DataFrame, upper: DataFrame, height: int, emit, schema: T.StructType, own: list[str]) -> DataFrame:
    """Rows that emit(rows, witnesses, above) gives for each block, in batches.
    upper: g, pos (the block), steps, top: the witness of each block's root and
    the group's root. It comes before the block's nodes, once."""
    names = ["g", "block", "pos", "n", "digest", "steps", "top", *own]
    kinds = {f.name: f.dataType for f in [*nodes.schema.fields, *upper.schema.fields]}
    null = lambda c: F.lit(None).cast(kinds[c]).alias(c)
    below = _dealt(nodes, height).select(*[null(c) if c in ("steps", "top") else F.col(c) for c in names])
    above = upper.select(*[F.col("pos").alias("block") if c == "block" else F.lit(-1).cast("long").alias("pos") if c == "pos" else F.col(c) if c in ("g", "steps", "top") else null(c) for c in names])

    def walk(batches):
        key, tree, size, leaves, rows, head = None, None, 0, [], [], None

        def close():
            tree.finish(min(height, levels_of(size)))
            yield from emit(key, rows, [partial_witness(x) for x in leaves], head)

        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            for row in zip(*columns):
                g, block, pos, n, value, steps, top = row[:7]
                if tree is None or (g, block) != key:
                    if leaves:
                        yield from close()
                    key, tree, leaves, rows, head = (g, block), Appender(), [], [], None
                if pos == -1:
                    head = ([(s["at"], s["others"]) for s in steps], top)
                    continue
                size = n
                leaves.append(tree.append(value))
                rows.append(row)
        if leaves:
            yield from close()

    both = below.unionByName(above).repartition("g", "block").sortWithinPartitions("g", "block", "pos")
    return both.mapInArrow(C.tidy(walk), schema)


def _lowered(nodes: DataFrame, upper: DataFrame, height: int, label: str) -> DataFrame:
    """upper one tree further down: g, pos, steps, top of each of nodes."""
    schema = T.StructType([nodes.schema["g"], T.StructField("pos", T.LongType()), T.StructField("steps", _STEPS), T.StructField("top", T.StringType())])

    def emit(key, rows, witnesses, head):
        for lo in range(0, len(rows), 256):
            part = rows[lo : lo + 256]
            steps = [[{"at": a, "others": o} for a, o in w + head[0]] for w in witnesses[lo : lo + 256]]
            yield C.arrow_rows(schema, g=[key[0]] * len(part), pos=[r[2] for r in part], steps=steps, top=[head[1]] * len(part))

    return C.materialise(_descend(nodes, upper, height, emit, schema, []), label)


def merkle_manifest(rows: DataFrame, *, id_col: str = "doc_id", group_col: str = "source", leaf_col: str = "leaf", present_col: str | None = None, witness: bool = False, height: int = HEIGHT) -> DataFrame:
    """The manifest of rows with their leaves (lowercase hex digests).

    A group's leaves ascend by id, then leaf. While several nodes remain, every
    16 in a row (the last run: fewer, even one) become the digest of their
    digests; what remains is the subroot, for a lone leaf itself. The subroots,
    by group, give the root likewise. Returns id, leaf, subroot, root,
    proof_sha256 (of the siblings, level by level up to the root), folded_root
    (of present_col, or else the leaf, with those siblings) and verified (it is
    the root); with witness also steps: at (the place among the siblings) and
    others (their digests) of each level.

    One row for each input row. A null group is a group, before all others, and
    a null id comes before all others; groups ascend bytewise. Repeated rows are
    leaves each and tie without effect. An empty table gives an empty result;
    columns beside those named play no part, whatever their names.
    """
    present = F.col(present_col or leaf_col)
    leaves = C.materialise(rows.select(F.col(id_col).alias("id"), F.col(group_col).alias("g"), F.col(leaf_col).alias("digest"), present.alias("present")), "leaves")
    tables = _towers(C.materialise(ranked(leaves, "g", ["id", "digest"]), "ranked"), height, "blocks")
    subroots = tables[-1].select(F.col("g").alias("group"), F.col("digest").alias("subroot"))
    tops = C.materialise(ranked(subroots.select(F.lit(None).cast("string").alias("g"), "group", F.col("subroot").alias("digest")), "g", ["group"]), "subroots")
    crown = _towers(tops, height, "crown")
    last = crown[-1].first()
    root = last["digest"] if last else None

    upper = crown[-1].select("g", "pos", F.array().cast(_STEPS).alias("steps"), F.lit(root).alias("top"))
    for nodes in reversed(crown[:-1]):
        upper = _lowered(nodes, upper, height, "crown_steps")
    # the places among all groups lead to the groups' own trees
    upper = tops.select(F.col("group").alias("g"), F.col("digest").alias("top"), F.col("pos").alias("place")).join(upper.select(F.col("pos").alias("place"), "steps"), "place").select("g", F.lit(0).cast("long").alias("pos"), "steps", "top")
    for nodes in reversed(tables[1:-1]):
        upper = _lowered(nodes, upper, height, "steps")

    texts = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = T.StructType([T.StructField("id", rows.schema[id_col].dataType), *[T.StructField(c, T.StringType()) for c in texts], T.StructField("verified", T.BooleanType()), *([T.StructField("steps", _STEPS)] if witness else [])])

    def emit(key, block, witnesses, head):
        above = "".join(o for _, o in head[0])
        for lo in range(0, len(block), 256):
            part, own = block[lo : lo + 256], witnesses[lo : lo + 256]
            folded = [fold(r[8], w + head[0]) for r, w in zip(part, own)]
            out = {
                "id": [r[7] for r in part], "leaf": [r[4] for r in part], "subroot": [head[1]] * len(part), "root": [root] * len(part),
                "proof_sha256": [digest("".join(o for _, o in w) + above) for w in own], "folded_root": folded, "verified": [x == root for x in folded],
            }
            if witness:
                out["steps"] = [[{"at": a, "others": o} for a, o in w + head[0]] for w in own]
            yield C.arrow_rows(schema, **out)

    return _descend(tables[0], upper, height, emit, schema, ["id", "present"]).withColumnRenamed("id", id_col)


def _op13_sql(levels: int = 6) -> str:
    """The levels written out: groups up to 16 ** levels rows, and as many groups."""

    def tree(name: str, nodes: str, keys: str) -> str:
        out = f"{name}0 as ({nodes})"
        for k in range(levels):
            out += f""", {name}r{k} as (
    select {keys}, pos // 16 as pos, first(n) as n, list(digest order by pos) as run from {name}{k} group by {keys}, pos // 16
), {name}{k + 1} as (
    select {keys}, pos, case when n > 1 then (n + 15) // 16 else 1 end as n, case when n > 1 then sha256(array_to_string(run, '')) else run[1] end as digest from {name}r{k}
)"""
        return out

    def climb(name: str, start: str, keys: str) -> str:
        out, before = "", start
        for k in range(levels):
            own = f"x.pos % 16 + 1"  # noqa: F541
            out += f""", {name}c{k} as (
    select x.* exclude (pos, proof, folded), x.pos // 16 as pos,
        case when r.n > 1 then x.proof || array_to_string(list_filter(r.run, lambda d, i: i != {own}), '') else x.proof end as proof,
        case when r.n > 1 then sha256(array_to_string(list_transform(r.run, lambda d, i: case when i = {own} then x.folded else d end), '')) else x.folded end as folded
    from {before} x join {name}r{k} r on x.{keys} is not distinct from r.{keys} and x.pos // 16 = r.pos
)"""
            before = f"{name}c{k}"
        return out

    def leaf(text: str) -> str:
        fields = [f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(fields)})"

    return f"""
with recursive {C.CRC_TABLE_SQL}, hashed as (
    select doc_id, source, {leaf("text")} as leaf, {leaf("lowered")} as lowered_leaf, {C.crc_sql("doc_id::varchar")} as h
    from (select *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered from documents), crc
), leaves as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n from hashed
), {tree("t", "select source, pos, n, leaf as digest from leaves", "source")}, tops as (
    select 0 as one, source, digest, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n from t{levels}
), {tree("u", "select one, pos, n, digest from tops", "one")}, begun as (
    select doc_id, source, leaf, pos, '' as proof, case when h % 5 = 0 then lowered_leaf else leaf end as folded from leaves
){climb("t", "begun", "source")}, lifted as (
    select c.* exclude (pos), s.digest as subroot, s.one, s.pos as pos from tc{levels - 1} c join tops s on c.source is not distinct from s.source
){climb("u", "lifted", "one")}
select c.doc_id, c.leaf, c.subroot, r.digest as root, sha256(c.proof) as proof_sha256, c.folded as folded_root, c.folded = r.digest as verified
from uc{levels - 1} c, u{levels} r
"""


OP13_SQL = _op13_sql()


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Manifest of the documents; a fifth of them is checked after tampering."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = row_hash(columns)
    tampered = row_hash([*columns[:-1], F.translate("text", upper, lower)])
    present = F.when(C.crc_bucket("doc_id", 5) == 0, tampered).otherwise(leaf)
    return merkle_manifest(docs.select("doc_id", "source", leaf.alias("leaf"), present.alias("present")), present_col="present")
