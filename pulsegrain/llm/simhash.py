"""SimHash near-duplicates with pigeonring candidate filtering.

With a budget of t differing bits and t + 1 segments in a ring, two linked
fingerprints have a segment from which every run of l segments differs in at
most floor(l * t / (t + 1)) = l - 1 bits. The first link of that chain is an
exact match, which is the join key; the longer ones prune candidates before
the full Hamming check.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .components import connected_components
from .near_copies import near_copy_roots
from .pigeonring import hamming_links



def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of one text over word shingles (XXH64, seed 42)."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n < shingle:
        return digest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    m = n - shingle + 1
    h = np.fromiter((digest(joined[a:z], 42) for a, z in zip(starts[:m].tolist(), ends[shingle - 1 :].tolist())), np.uint64, m)
    total = np.zeros(64, np.int64)
    for lo in range(0, m, 1 << 15):
        part = h[lo : lo + (1 << 15)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > m, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(id, fp long) of every row."""
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.LongType())])

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield C.arrow_rows(schema, **{id_col: b.column(0), "fp": np.array(fps, np.uint64).view(np.int64)})

    return docs.select(id_col, text_col).mapInArrow(C.tidy(run), schema)


def simhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Fingerprint and near-duplicate component of every row.

    Returns id, fp (long), component_id: the smallest id that links of at most
    two bits reach. One row for each input row. Null and empty texts
    have fingerprint zero and are linked like any other; rows with a null id
    link nothing and have a null component. Rows of one id are one node. Extra
    columns are ignored; an empty table gives an empty result; a text of any
    length is read whole by one task.
    """
    fps = C.materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    same = fps.where(F.col(id_col).isNotNull()).groupBy("fp").agg(F.min(id_col).alias("node"))
    reps = C.materialise(same, "classes")
    # an id with several texts ties its fingerprints together
    ids = fps.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("fp").alias("x"), F.max("fp").alias("fp")).where("x != fp").select(id_col)
    tied = fps.join(ids, id_col).join(reps, "fp").select(F.col(id_col).alias("a"), F.col("node").alias("b"))
    links = hamming_links(reps).unionByName(tied)
    comps = connected_components(links)
    roots = reps.join(comps, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    out = fps.join(roots, "fp", "left")
    return out.select(id_col, "fp", F.when(F.col(id_col).isNotNull(), F.col("component_id")).alias("component_id"))


def near_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int | None = None) -> DataFrame:
    """docs without near duplicates: of each component the smallest id stays.

    Texts are linked by fingerprints that differ in two bits at most or, with
    `percent`, by shingle sets of at least that Jaccard similarity. There the
    fingerprints give the first candidates; 64 bits cannot tell all (texts of
    similarity 0.8 are 10 bits apart on average, and up to 20), so what they
    leave is searched by the sets, and every link is checked exactly.

    Rows with a null id stay; of rows with one id one stays. Null and empty
    texts are one component like any other. Columns pass through, whatever
    their names; an empty table stays empty.
    """
    own = docs.select(id_col, text_col)
    if percent is None:
        comps = simhash_components(own, id_col=id_col, text_col=text_col, shingle=shingle)
        keep = comps.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    else:
        keep = near_copy_roots(own, id_col=id_col, text_col=text_col, shingle=shingle, percent=percent)
    kept = docs.where(F.col(id_col).isNotNull()).join(keep, id_col, "left_semi")
    return kept.dropDuplicates([id_col]).unionByName(docs.where(F.col(id_col).isNull())).select(*docs.columns)


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = simhash_components(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
