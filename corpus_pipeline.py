"""From raw documents to token ids, in stages that are each written before the next.

1. quality: documents the classifier gives less than ``KEEP_SCORE`` go
2. near_dedup: documents whose SimHash fingerprints of 4-word shingles are linked by 4 or fewer
   bits form groups, of which the document with the smallest id stays
3. substring_dedup: words inside stretches of 35 words that occur twice or more go,
   and documents of which no word is left
4. decontaminate: documents that hold a window of the benchmark go
5. tokenize: ids of what is left

Stages 1 to 4 return the columns of documents. Rows that share a doc_id are documents of their own; null
texts count as empty, null ids as the smallest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joblark.llm import bpe, decontaminate, quality_classifier, simhash, substring_dedup
from joblark.session import materialize

KEEP_SCORE = 0.3
# Not every stage of a pipeline has SQL: fingerprints, discriminants and BPE do not.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _row(docs: DataFrame):
    """All columns as one, under a name of its own."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality_classifier.quality_scores(docs, _table(spark, sf_dir, "labels"), F.lit(False), _row(docs))
    return scored.where(F.col("score") >= KEEP_SCORE).select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_rows(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(docs, _row(docs))
    left = found.where((F.col("kept_words") != "") | (F.col("n_words") == 0))
    cut = F.size("spans") > 0
    new = {"text": F.when(cut, F.col("kept")).otherwise(F.col("_row.text")), "n_chars": F.when(cut, F.char_length("kept").cast("long")).otherwise(F.col("_row.n_chars"))}
    return left.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"), _row(docs))
    return found.where(F.size("runs") == 0).select("_row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substrings),
    ("decontaminate", decontaminated),
    ("tokenize", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
