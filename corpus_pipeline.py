"""The corpus pipeline: quality classifier, exact dedup, MinHash near-dedup, source mixing, BPE.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes what a stage returns as
Parquet below the shared checkpoint folder and reads it again as the next one's ``docs``. All
but the last return the columns of documents.

What the stages do with awkward rows: a null text counts as empty. The classifier scores empty and very
long texts like any other; without labels of both classes it rejects none. All texts without a word are one
text to exact dedup, which keeps the row with the longest text, then the smallest doc_id, a null one
last; of rows that agree in both, one. MinHash leaves texts without words alone, and a doc_id with
several rows goes only if none of them is kept. The mix repeats rows (and with them doc_ids); a null
source is a source of its own, and a source without words gives none. BPE returns a row for each row
that the mix gives; no tokens for an empty text. Extra columns, whatever their names, are carried along.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hebdo.llm import bpe, exact_dedup, minhash, mixing, qda
from hebdo.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    return qda.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each distinct text."""
    return exact_dedup.drop_exact_copies(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_sources(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and hashes of the ids and of what they decode to, per document of the mix."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_deduplication),
    ("MinHash near-dedup", near_deduplication),
    ("source mix", source_mix),
    ("byte-level BPE", tokenise),
]

#: A fitted discriminant, MinHash groups and BPE are not SQL; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
