"""From raw documents to token ids: rules, near-duplicates, test items, secrets, encoding.

Every stage works on all documents that the one before kept, and is written to the shared
folder before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import fertility, fmindex, hyperminhash, ownership, tree_bpe
from tideline.llm.common import table
from tideline.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within their language's fertility bands."""
    return fertility.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return hyperminhash.without_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark; nothing but passages goes whole."""
    return fmindex.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return ownership.redacted(docs, F.col("source"), F.concat_ws("/", "source", "lang"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit integers), and the decoded text's digest."""
    done = tree_bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return done.select(
        "keys.*", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("encoding", encoding),
]

#: Tokenizers and shingle links can't be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
