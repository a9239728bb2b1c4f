"""Bounded training samples from a table of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stratified_sample

#: Bytes of the longest text that is learnt from.
LONGEST = 200_000


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, train: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST) -> DataFrame:
    """(id, text, y: 0 or 1) of at most per_class training rows of either label,
    those with the smallest id hash. Ids with both labels, null ids, other labels
    and texts of over `longest` bytes are left out. The ids are chosen on narrow
    columns."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & train).groupBy(id_col).agg(F.min(label_col).alias("y"), F.max(label_col).alias("most")).where("y = most")
    docs = docs.where(F.col(text_col).isNotNull() & (F.octet_length(text_col) <= longest)).select(id_col, text_col)
    picked = stratified_sample(one.join(docs.select(id_col), id_col, "left_semi").select(id_col, "y"), "y", F.xxhash64(F.col(id_col)), per_class)
    return docs.join(F.broadcast(picked), id_col).dropDuplicates([id_col])


def training_texts(docs: DataFrame, labels: DataFrame, label_col: str, train: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST) -> list[tuple[str, int]]:
    """(text, 0 or 1) of training_rows in a fixed order; 2 * per_class texts of
    at most `longest` bytes reach the driver."""
    rows = training_rows(docs, labels, label_col, train, per_class, id_col, text_col, longest)
    return [(r[0], int(r[1])) for r in rows.orderBy(F.xxhash64(F.col(id_col)), id_col).select(text_col, "y").collect()]
