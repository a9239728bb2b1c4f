"""The corpus pipeline: documents through the training-data operators.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; all but the last return the columns of documents. What holds for every
stage: columns that docs has besides doc_id, text and n_chars pass through,
whatever their names (packing returns its own); rows with a null doc_id stay;
an empty table gives an empty result; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm import common as C
from pulsegrain.llm.packing import pack_documents
from pulsegrain.llm.pii import redact_pii
from pulsegrain.llm.simhash import near_dedup
from pulsegrain.llm.substring_dedup import remove_repeats
from pulsegrain.llm.toxicity import score_toxicity


def _resized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go. Null and empty texts
    score 0 and stay; repeated rows are judged each, alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score, predicted = C.fresh(docs, "score", "predicted")
    scored = score_toxicity(docs, labels, C.crc_bucket("doc_id", 3) != 1, score_col=score, predicted_col=predicted)
    return scored.where(F.col(predicted) == 0).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that near copies link (five-word shingles, similarity of 0.8 or
    more; candidates by SimHash and pigeonring chains, then by prefixes for what
    64 bits cannot tell) the smallest id stays. Texts without words, null ones among them, are
    alike, so one of them stays; so does one of the rows with one id."""
    return near_dedup(docs, shingle=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a document with a smaller id has go. Every row
    stays; null texts stay null and a text may become empty. n_chars follows."""
    return _resized(remove_repeats(docs, counts=False))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind. Every row stays; null texts stay
    null. n_chars follows."""
    return _resized(redact_pii(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place. Null and
    empty texts are one token; repeated rows are packed each."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("substrings", substrings), ("personal_data", personal_data), ("packing", packing)]
#: SQL cannot express the trained models nor the packing; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = C.materialise(docs, name)
    return docs
