"""The operators as registered queries over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.llm import (
    bpe, chat, exact_dedup, filter_audit, licenses, line_dedup, minhash, mixing, qda, quality_rules, substring_dedup, warc,
    whitening,
)
from hebdo.llm.common import table
from hebdo.llm.oracles import ORACLES  # noqa: F401 - read by the entry module

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document, and its source's target."""
    planned = mixing.plan_copies(table(spark, sf_dir, "documents"))
    return planned.select("row.doc_id", "size", "source_size", "target",
                          (F.col("copies") * F.col("size")).alias("taken"))


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row of each that stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and what they decode to, as hashes."""
    import public_tokenizers

    return bpe.encode_documents(table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages written as WARC archives and read back."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return qda.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    return minhash.near_groups(table(spark, sf_dir, "documents"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without the 200-byte strings that occur again."""
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document; documents labelled good are trusted."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality_rules.quality(table(spark, sf_dir, "documents"), trusted).drop("score")


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered, and those left out."""
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license notices of every document, with the words each lacks and adds."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "first_line", "last_line", "license",
                        F.array_join("missing", " ").alias("missing"), F.array_join("added", " ").alias("added"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's first four whitened components, a row for each."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.select("vec_id", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "identity_error", F.posexplode(
        F.arrays_zip("whitened", "explained")).alias("at", "of")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "of.whitened", "of.explained", "identity_error")


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, by language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, those it loses to a smaller doc_id, and what remains."""
    cut = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
