"""Corpus preparation: quality rules, near-duplicates, decontamination, personal data,
encoding. Part of the ``llm`` subpackage.

Each stage takes the documents that its predecessor kept, as a written Parquet table. All
but the last return the columns of ``documents``, extra ones included, whatever their names;
the last returns each document's ids.

Defined results. A null, empty or short text fails the quality rules, so its row leaves in
the first stage. A line that many documents of a host share leaves their texts. Of near
copies, and of repeated rows, the one with the smallest id stays (a null id ranks last; rows
alike in id and text are one). Texts of any length are read whole. An empty table gives an
empty result. A null host, language or count changes nothing; such rows pass like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import bpe_codec, decontaminate, pii, quality_rules, simhash
from tidewatch.llm.common import table
from tidewatch.llm.queries import vocabulary
from tidewatch.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail the base rules or are depleted of their own lines."""
    return quality_rules.reject(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near copies."""
    return simhash.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    return pii.redact(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (little-endian 32-bit), with their digests."""
    return bpe_codec.encode_decode(docs, vocabulary(), keep=("ids",))


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", encoding_stage),
]

# latent retrieval and BPE have no SQL; tests/llm compares with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
