"""Approximate nearest neighbours by balanced posting lists.

A bounded sample is halved again and again at medians, so that its cells are
equal in size; their means are the centroids. A vector is posted to its
nearest centroid and, near a boundary, to others almost as near. A graph of the
centroids, small enough for memory, is searched to find them. A query reads the
lists whose centroid is at most a ratio times as far as its nearest one; the
ratio is the least that reaches a wanted recall for a bounded number of
questions that are answered by brute force beforehand.

The number of centroids in memory is bounded. Lists that are long in spite of
them have centroids of their own, fitted and used where the list's vectors are,
and are read in parts by the same rule, so that what a query scans does not
grow with the table.

Equal vectors are one class: the index holds one copy, and as many of the
smallest ids as an answer can use. Largest inner product becomes smallest
distance by one more component that makes all norms equal.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import common as C

SAMPLE = 40_000
#: Vectors in a posting list on average, without copies, and the most centroids
#: held in memory. A list of over LONG times its usual length gets own centroids,
#: PARTS at most; they are fitted on PART_SAMPLE vectors at most.
LIST, CENTROIDS = 160, 8192
LONG, PARTS, PART_SAMPLE = 4, 1024, 20_000
#: Bytes of vectors that one task holds, and tasks that lists are dealt to at least.
HELD, GROUPS = 32 << 20, 16
#: Distances to centroids in memory at once while those are fitted.
CELLS = 1 << 20
#: Vectors of a long list, or questions that read it, that meet in a task.
BLOCK = 20_000
#: A part's number is its list's times this plus its place in the list.
UNIT = 1 << 20
#: Questions answered by brute force to find the ratio.
CALIBRATED = 256


@dataclass
class CentroidGraph:
    """Centroids (extended by the norm component), each one's nearest others
    and some far ones, and where a search begins."""

    centroids: np.ndarray
    links: np.ndarray
    entry: np.ndarray
    top: float

    def extend(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors with the component that makes their norm `top`; queries are
        scaled to it instead, which leaves the order of inner products alone."""
        if query:
            norm = np.sqrt((x * x).sum(1))[:, None]
            return np.concatenate([x * (self.top / np.where(norm > 0, norm, 1)), np.zeros((len(x), 1))], 1)
        return np.concatenate([x, np.sqrt(np.maximum(self.top**2 - (x * x).sum(1), 0))[:, None]], 1)

    def distances(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Squared distances of each x to its own centroids."""
        c = self.centroids[at]
        return np.maximum((x * x).sum(1)[:, None] - 2 * np.einsum("bd,bkd->bk", x, c) + (c * c).sum(2), 0)

    def nearest(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, squared distances), nearest first, `beam` for each x: a
        best-first search of the graph for the whole batch at once."""
        k, b = len(self.centroids), len(x)
        beam = min(beam, k)
        if beam * 4 >= k:  # as many as that: no search is shorter than the list
            d = np.maximum((x * x).sum(1)[:, None] - 2 * x @ self.centroids.T + (self.centroids**2).sum(1), 0)
            at = np.argsort(d, 1, kind="stable")[:, :beam]
            return at, np.take_along_axis(d, at, 1)
        rows = np.arange(b)[:, None]
        known = np.zeros((b, k), bool)
        at = np.broadcast_to(self.entry, (b, len(self.entry))).copy()
        known[rows, at] = True
        d = self.distances(x, at)
        done = np.zeros(at.shape, bool)
        while True:
            order = np.argsort(d, 1, kind="stable")[:, :beam]
            at, d, done = (np.take_along_axis(v, order, 1) for v in (at, d, done))
            open_ = ~done & np.isfinite(d)
            live = np.flatnonzero(open_.any(1))
            if not len(live):
                return at, d
            pick = open_[live].argmax(1)
            done[live, pick] = True
            near = np.sort(self.links[at[live, pick]], 1)
            fresh = ~known[live[:, None], near]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            known[live[:, None], near] = True
            new = np.where(fresh, self.distances(x[live], near), np.inf)
            more_at, more_d = np.zeros((b, near.shape[1]), at.dtype), np.full((b, near.shape[1]), np.inf)
            more_at[live], more_d[live] = near, new
            at, d = np.concatenate([at, more_at], 1), np.concatenate([d, more_d], 1)
            done = np.concatenate([done, np.zeros(more_at.shape, bool)], 1)

    def within(self, x: np.ndarray, ratio: float, least: int = 1, most: int | None = None, beam: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, centroid, squared distance) of all centroids at most `ratio`
        times as far as the nearest, and of the `least` nearest anyhow; of these
        the `most` nearest. The beam grows until it reaches past that."""
        rows, ats, ds = [], [], []
        left, beam = np.arange(len(x)), max(beam if most is None else 2 * most, least)
        while len(left):
            at, d = self.nearest(x[left], beam)
            at, d = at[:, :most], d[:, :most]
            limit = d[:, :1] * ratio**2 + 1e-12
            short = (d[:, -1] <= limit[:, 0]) & (at.shape[1] < min(len(self.centroids), most or len(self.centroids)))
            keep = ((d <= limit) | (np.arange(d.shape[1]) < least)) & ~short[:, None]
            r, c = np.nonzero(keep)
            rows.append(left[r])
            ats.append(at[r, c])
            ds.append(d[r, c])
            left, beam = left[short], beam * 4
        return np.concatenate(rows or [left]), np.concatenate(ats or [left]), np.concatenate(ds or [left.astype(float)])


def _cell_of(x: np.ndarray, centroids: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Each row's centroid of the least weighted squared distance. Rows go in
    blocks, so that memory does not grow with their number times the centroids'."""
    step = max(1, CELLS // len(centroids))
    return np.concatenate([(weight * ((y * y).sum(1)[:, None] - 2 * y @ centroids.T + (centroids**2).sum(1))).argmin(1) for y in (x[lo : lo + step] for lo in range(0, len(x), step))])


def fit_graph(sample: np.ndarray, top: float, lists: int, degree: int = 16, seed: int = 2) -> CentroidGraph:
    """Centroids of `lists` equal cells of the sample and their graph."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([sample, np.sqrt(np.maximum(top**2 - (sample**2).sum(1), 0))[:, None]], 1)
    cells = [np.arange(len(x))]
    lists = max(1, min(lists, len(x)))
    while len(cells) < lists:
        cells.sort(key=len)
        own = cells.pop()
        if len(own) < 2:
            cells.append(own)
            break
        a, b = x[rng.choice(own, 2, replace=False)]
        for _ in range(4):
            side = ((x[own] - a) ** 2).sum(1) < ((x[own] - b) ** 2).sum(1)
            if side.all() or not side.any():
                break
            a, b = x[own[side]].mean(0), x[own[~side]].mean(0)
        order = own[np.argsort(x[own] @ (b - a), kind="stable")]
        cells += [order[: len(own) // 2], order[len(own) // 2 :]]
    centroids = np.stack([x[c].mean(0) for c in cells])
    # a few rounds of means, where full cells look farther than they are
    size = np.array([len(c) for c in cells], float)
    for _ in range(4):
        own = _cell_of(x, centroids, 1 + 0.1 * (size / size.mean() - 1).clip(-0.9, 3))
        size = np.bincount(own, minlength=len(centroids)).astype(float)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        centroids = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centroids)
    k = len(centroids)
    near = np.empty((k, min(degree, k)), np.int64)
    step = max(1, CELLS // k)
    for lo in range(0, k, step):
        y = centroids[lo : lo + step]
        d = (y * y).sum(1)[:, None] - 2 * y @ centroids.T + (centroids**2).sum(1)
        near[lo : lo + step] = np.argsort(d, 1, kind="stable")[:, : near.shape[1]]
    # links go both ways, up to twice the degree; a ring keeps the graph in one
    # piece and a few far links shorten its paths
    links = np.repeat(np.arange(k)[:, None], 3 * degree + 4, 1)
    links[:, : near.shape[1]] = near
    used = np.full(k, degree)
    for a, b in zip(np.repeat(np.arange(k), near.shape[1]).tolist(), near.ravel().tolist()):
        if used[b] < 3 * degree:
            links[b, used[b]] = a
            used[b] += 1
    links[:, -4] = (np.arange(k) + 1) % k
    links[:, -3:] = rng.integers(0, k, (k, 3))
    return CentroidGraph(centroids, links, np.unique(rng.integers(0, k, min(k, 32))), top)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten(), np.float64).reshape(-1, dim)


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the rows with an id and a vector that is not
    null, empty or zero and has no null or non-finite component; equal rows once."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    out = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    return out.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0)).dropDuplicates(["id", "v"])


def calibrate(classes: DataFrame, graph, dim: int, k: int, boundary: float, replicas: int, recall: float, asked: int = CALIBRATED) -> float:
    """The least ratio by which that share of the k nearest of `asked` classes
    (those with the smallest hashes of a thinned set) is found. Each task keeps
    its k best for each question; the exact answers come from those."""
    from pyspark.sql.pandas.types import to_arrow_schema

    n = classes.count()
    thin = classes.where(F.pmod(F.xxhash64("cls", F.lit(31)), F.lit(1_000_003)) <= 1_000_003 * min(1.0, 4 * asked / n))
    chosen = thin.orderBy(F.xxhash64("cls", F.lit(31)), "cls").limit(asked).toArrow()
    questions = classes.sparkSession.sparkContext.broadcast((chosen.column("cls").combine_chunks(), _matrix(chosen.column("v"), dim)))
    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("cls", classes.schema["cls"].dataType), T.StructField("score", T.DoubleType()), T.StructField("need", T.DoubleType())])

    def run(batches):
        own, x = questions.value
        m, best, ids, vectors = len(own), np.zeros((len(own), 0)), np.zeros((len(own), 0), np.int64), np.zeros((len(own), 0, dim))
        cls, seen = [], 0
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                v = _matrix(part.column(1), dim)
                score = np.concatenate([best, x @ v.T], 1)
                top = np.argsort(-score, 1, kind="stable")[:, : k + 1]
                old = top < best.shape[1]
                at = np.where(old, 0, top - best.shape[1])
                cls.append(part.column(0))
                if best.shape[1]:
                    was = np.minimum(top, best.shape[1] - 1)
                    ids = np.where(old, np.take_along_axis(ids, was, 1), at + seen)
                    vectors = np.where(old[:, :, None], np.take_along_axis(vectors, was[:, :, None], 1), v[at])
                else:
                    ids, vectors = at + seen, v[at]
                best = np.take_along_axis(score, top, 1)
                seen += part.num_rows
        if not seen:
            return
        g = graph.value
        cls = pa.concat_arrays([c if isinstance(c, pa.Array) else c.combine_chunks() for c in cls])
        row, at, _ = g.within(g.extend(vectors.reshape(-1, dim)), boundary, most=replicas)
        ext = g.extend(x, True)
        first = g.nearest(ext, 16)[1][:, 0]
        q = np.repeat(np.arange(m), best.shape[1])
        far = np.concatenate([g.distances(ext[q[row[i : i + 4096]]], at[i : i + 4096, None])[:, 0] for i in range(0, len(row), 4096)])
        need = np.full(len(q), np.inf)
        np.minimum.at(need, row, far)
        hit = pa.array(ids.ravel())
        yield C.arrow_rows(schema, q=q.astype(np.int32), cls=cls.take(hit), score=best.ravel(), need=np.sqrt(need / np.maximum(first[q], 1e-300)))

    hits = classes.select("cls", "v").mapInArrow(C.tidy(run), schema)
    mine = chosen.select(["cls"]).append_column("q", pa.array(np.arange(chosen.num_rows, dtype=np.int32)))
    mine = classes.sparkSession.createDataFrame(mine.to_pylist(), T.StructType([T.StructField("cls", classes.schema["cls"].dataType), T.StructField("q", T.IntegerType())]))
    hits = hits.join(F.broadcast(mine), ["cls", "q"], "left_anti")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "cls")
    needs = hits.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).select("need").toArrow().column(0).to_numpy()
    return max(1.0, float(np.quantile(needs, recall, method="higher"))) * (1 + 1e-9) if len(needs) else 1.0


def nearest_neighbours(
    vectors: DataFrame, queries, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, recall: float = 0.93, ratio: float | None = None, least: int = 4, boundary: float = 1.1, replicas: int = 8, sample: int = SAMPLE, list_size: int = LIST, centroids: int = CENTROIDS
) -> DataFrame:
    """The k nearest rows found, by largest inner product, for each query row.

    queries: boolean column over `id`. A list is read if its centroid is at most
    `ratio` times as far as the nearest one (by default the ratio that `calibrate`
    finds for `recall`); the `least` nearest lists are read anyhow. boundary is
    the same for posting a vector, to `replicas` lists at most. sample bounds the
    rows that centroids are fitted on, centroids their number; every row is
    indexed. Queries whose lists hold too few vectors for a full answer read all.

    Returns query_id, rank (from 1), id, score, fewer than k where there are
    fewer candidates. Rows that valid_vectors drops take no part, as queries or
    candidates. Vectors of different lengths have no inner product: each length
    is a search of its own, and over 64 of them are an error. A row is not its
    own candidate, nor are rows with its id; equal rows count once; ties go to
    the smaller id. Other columns play no part; an empty table has no answers.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType
    rows = C.materialise(valid_vectors(vectors, id_col, vector_col), "vectors")
    dims = [r[0] for r in rows.groupBy(F.size("v").alias("dim")).count().orderBy("dim").limit(65).collect()]
    if len(dims) > 64:
        raise ValueError("vectors of more than 64 lengths")
    out = None
    for dim in dims:
        found = _search(rows.where(F.size("v") == dim), dim, queries, k, recall, ratio, least, boundary, replicas, sample, list_size, centroids, id_col)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField("query_id", id_type), T.StructField("rank", T.IntegerType()), T.StructField(id_col, id_type), T.StructField("score", T.DoubleType())]))
    return out


def _search(rows: DataFrame, dim: int, queries, k: int, recall: float, ratio: float | None, least: int, boundary: float, replicas: int, sample: int, list_size: int, most_lists: int, id_col: str) -> DataFrame:
    spark, id_type = rows.sparkSession, rows.schema["id"].dataType
    # a class of equal vectors: its smallest id, and the k + 1 smallest
    classes = C.materialise(rows.groupBy("v").agg(F.min("id").alias("cls")), "classes")
    top = Window.partitionBy("v").orderBy("id")
    members = rows.withColumn("__r", F.row_number().over(top)).where(F.col("__r") <= k + 1).drop("__r")
    members = C.materialise(members.join(classes, "v").select("cls", "id"), "members")
    asked = C.materialise(rows.where(queries).join(classes, "v").select("id", "cls", "v"), "asked")

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, most = classes.agg(F.count("*"), F.max(norm)).first()
    lists = max(1, min(most_lists, -(-n // list_size)))
    part = min(1.0, 1.2 * sample / n)
    chosen = classes.where(F.pmod(F.xxhash64("cls", F.lit(9)), F.lit(1_000_003)) < part * 1_000_003).select("v").limit(sample).toArrow()
    fitted = _matrix(chosen.column(0), dim) if chosen.num_rows else _matrix(classes.select("v").limit(1).toArrow().column(0), dim)
    graph = spark.sparkContext.broadcast(fit_graph(fitted, float(most) * (1 + 1e-9), lists))
    if ratio is None:
        ratio = calibrate(classes, graph, dim, k, boundary, replicas, recall)

    vector = T.ArrayType(T.DoubleType())
    posted_schema = T.StructType([T.StructField("cls", id_type), T.StructField("v", vector), T.StructField("unit", T.LongType())])

    def post(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                row, at, _ = graph.value.within(graph.value.extend(_matrix(part.column(1), dim)), boundary, most=replicas)
                idx = pa.array(row)
                yield C.arrow_rows(posted_schema, cls=part.column(0).take(idx), v=part.column(1).take(idx), unit=at.astype(np.int64) * UNIT)

    posted = C.materialise(classes.select("cls", "v").mapInArrow(C.tidy(post), posted_schema), "postings")
    counts = {r[0]: r[1] for r in posted.groupBy("unit").count().collect()}  # most_lists at most
    usual = list_size * min(replicas, len(graph.value.centroids))
    long = {u: c for u, c in counts.items() if c > LONG * usual}
    parts = None
    if long:
        parts = _list_parts(posted, long, usual, dim)
        posted = C.materialise(_within_parts(posted, parts, long, graph, dim, boundary, replicas, posted_schema, False), "postings")
    groups = max(GROUPS, -(-sum(counts.values()) * (dim + 8) * 8 // HELD))
    posted = posted.withColumn("grp", F.pmod(F.xxhash64("unit"), F.lit(groups)).cast("int"))

    def choose(wanted: DataFrame, least_lists: int) -> DataFrame:
        """(cls, v, unit) of every list that a query reads."""

        def run(batches):
            for b in batches:
                for lo in range(0, b.num_rows, 512):
                    part = b.slice(lo, 512)
                    row, at, _ = graph.value.within(graph.value.extend(_matrix(part.column(1), dim), True), ratio, least_lists)
                    idx = pa.array(row)
                    yield C.arrow_rows(posted_schema, cls=part.column(0).take(idx), v=part.column(1).take(idx), unit=at.astype(np.int64) * UNIT)

        reads = wanted.select("cls", "v").mapInArrow(C.tidy(run), posted_schema)
        if parts is not None:
            # an own centroid may be as much farther again
            wide = 1 + 2 * (ratio - 1) if least_lists < len(graph.value.centroids) else float("inf")
            reads = _within_parts(reads, parts, long, graph, dim, wide, None, posted_schema, True)
        # a query meets each group once
        reads = reads.groupBy("cls", F.pmod(F.xxhash64("unit"), F.lit(groups)).cast("int").alias("grp")).agg(F.collect_set("unit").alias("units"))
        return reads.join(wanted.select("cls", "v"), "cls")

    pair_schema = T.StructType([T.StructField("qcls", id_type), T.StructField("cls", id_type), T.StructField("score", T.DoubleType())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        """The k + 1 best of a group's lists for each query that reads any."""
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(pair_schema)
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        v, query = _matrix(left.column("v"), dim), _matrix(right.column("v"), dim)
        own, asking = left.column("cls").combine_chunks(), right.column("cls").combine_chunks()
        cls = np.unique(own.to_numpy(zero_copy_only=False), return_inverse=True)[1]
        unit = left.column("unit").to_numpy()
        order = np.argsort(unit, kind="stable")
        wanted = right.column("units").combine_chunks()
        of_query = np.repeat(np.arange(len(query)), np.diff(np.asarray(wanted.offsets)))
        wanted = np.asarray(wanted.flatten())
        by_unit = np.argsort(wanted, kind="stable")
        qs, cs, ss = [], [], []
        for u in np.unique(unit):
            rows_u = order[slice(*np.searchsorted(unit[order], [u, u + 1]))]
            asked_u = of_query[by_unit[slice(*np.searchsorted(wanted[by_unit], [u, u + 1]))]]
            keep = min(k + 1, len(rows_u))
            for lo in range(0, len(asked_u), 1024):
                q = asked_u[lo : lo + 1024]
                s = query[q] @ v[rows_u].T
                # all that tie with the last place, so that the smaller id can win
                cut = np.partition(s, len(rows_u) - keep, axis=1)[:, len(rows_u) - keep]
                r, c = np.nonzero(s >= cut[:, None])
                qs.append(q[r])
                cs.append(rows_u[c])
                ss.append(s[r, c])
        if not qs:
            return schema.empty_table()
        q, c, s = np.concatenate(qs), np.concatenate(cs), np.concatenate(ss)
        # a vector posted to several of the lists counts once
        _, at = np.unique(q * np.int64(len(v)) + cls[c], return_index=True)
        q, c, s = q[at], c[at], s[at]
        order = np.lexsort((cls[c], -s, q))
        q, c, s = q[order], c[order], s[order]
        head = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
        place = np.arange(len(q)) - np.repeat(head, np.diff(np.append(head, len(q))))
        top_ = place <= k
        return pa.Table.from_arrays([asking.take(pa.array(q[top_])), own.take(pa.array(c[top_])), pa.array(s[top_])], schema=schema)

    def searched(wanted: DataFrame, least_lists: int) -> DataFrame:
        hits = posted.groupBy("grp").cogroup(choose(wanted, least_lists).groupBy("grp")).applyInArrow(search, pair_schema)
        return C.materialise(hits.groupBy("qcls", "cls").agg(F.max("score").alias("score")), "pairs")

    questions = C.materialise(asked.groupBy("cls").agg(F.first("v").alias("v")), "questions")
    pairs = searched(questions, least)
    enough = pairs.groupBy(F.col("qcls").alias("cls")).count().where(F.col("count") >= min(k + 1, n)).select("cls")
    short = C.materialise(questions.join(enough, "cls", "left_anti"), "short")
    if short.count():
        pairs = pairs.join(short.select(F.col("cls").alias("qcls")), "qcls", "left_anti").unionByName(searched(short, len(graph.value.centroids)))
    best = Window.partitionBy("qcls").orderBy(F.desc("score"), "cls")
    pairs = pairs.withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= k + 1).drop("__r")
    found = pairs.join(members, "cls").withColumn("__r", F.row_number().over(Window.partitionBy("qcls").orderBy(F.desc("score"), "id"))).where(F.col("__r") <= k + 1)
    answers = found.groupBy(F.col("qcls").alias("cls")).agg(F.sort_array(F.collect_list(F.struct("__r", "id", "score"))).alias("hits"))
    out = asked.select(F.col("id").alias("query_id"), "cls").join(answers, "cls")
    hits = F.slice(F.filter("hits", lambda h: h["id"] != F.col("query_id")), 1, k)
    out = out.select("query_id", F.posexplode(hits).alias("at", "h"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("h.id").alias(id_col), F.col("h.score").alias("score"))


def _list_parts(posted: DataFrame, long: dict[int, int], usual: int, dim: int) -> DataFrame:
    """(unit, n, parts): the own centroids of each long list, one after another."""
    schema = T.StructType([T.StructField("unit", T.LongType()), T.StructField("parts", T.ArrayType(T.DoubleType()))])

    def fit(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        x = _matrix(table.column("v"), dim)
        g = fit_graph(x, float(np.sqrt((x * x).sum(1)).max()) * (1 + 1e-9), max(2, min(PARTS, int(table.column("parts")[0].as_py()))))
        # without the norm component, which every list would scale by itself
        return pa.Table.from_arrays([pa.array([table.column("unit")[0].as_py()]), pa.array([g.centroids[:, :dim].ravel().tolist()])], schema=to_arrow_schema(schema))

    sizes = posted.sparkSession.createDataFrame([(u, -(-c // usual), min(1.0, PART_SAMPLE / c)) for u, c in long.items()], "unit long, parts long, share double")
    taken = posted.join(F.broadcast(sizes), "unit").where(F.pmod(F.xxhash64("cls", F.lit(17)), F.lit(1_000_003)) <= F.col("share") * 1_000_003)
    return C.materialise(taken.groupBy("unit").applyInArrow(fit, schema), "parts")


def _within_parts(rows: DataFrame, parts: DataFrame, long: dict[int, int], graph, dim: int, ratio: float, most: int | None, schema: T.StructType, query: bool) -> DataFrame:
    """rows (cls, v, unit) with the units of long lists replaced by those of
    their parts within `ratio`. Rows meet a list's centroids in blocks."""
    spark = rows.sparkSession
    sizes = F.broadcast(spark.createDataFrame([(u, max(1, -(-c // BLOCK))) for u, c in long.items()], "unit long, blocks long"))
    split = rows.join(sizes, "unit").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    keyed = parts.join(sizes, "unit").select("unit", "parts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        if not left.num_rows or not right.num_rows:
            return to_arrow_schema(schema).empty_table()
        own = np.asarray(right.column("parts").combine_chunks().flatten()).reshape(-1, dim)
        top = graph.value.top
        own = np.concatenate([own, np.sqrt(np.maximum(top**2 - (own * own).sum(1), 0))[:, None]], 1)
        unit, takes, units = left.column("unit")[0].as_py(), [], []
        x = graph.value.extend(_matrix(left.column("v"), dim), query)
        for lo in range(0, len(x), 2048):
            y = x[lo : lo + 2048]
            d = np.maximum((y * y).sum(1)[:, None] - 2 * y @ own.T + (own * own).sum(1), 0)
            keep = d <= d.min(1, keepdims=True) * ratio**2 + 1e-12
            if most is not None and most < d.shape[1]:
                keep &= d <= np.partition(d, most - 1, 1)[:, most - 1 : most]
            r, c = np.nonzero(keep)
            takes.append(r + lo)
            units.append(unit + c)
        at = pa.array(np.concatenate(takes))
        return pa.Table.from_arrays([left.column("cls").take(at), left.column("v").take(at), pa.array(np.concatenate(units).astype(np.int64))], schema=to_arrow_schema(schema))

    names = [f.name for f in schema]
    done = split.groupBy("unit", "block").cogroup(keyed.groupBy("unit", "block")).applyInArrow(run, schema)
    return done.select(*names).unionByName(rows.join(sizes, "unit", "left_anti").select(*names))


def op2_ann(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, F.pmod(F.col("id"), F.lit(20)) == 0)
