"""Corpus pipeline: five stages over the table documents.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage
before kept, and is written as Parquet in the shared folder before the next
one reads it. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofra.llm import byte_bpe, decontaminate, exact_dedup, quality, simhash
from asofra.llm.common import dropped, table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects.

    It is fitted on labelled rows of this stage's own input.
    """
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest doc_id of equal texts."""
    return exact_dedup.deduplicate(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the smallest doc_id, of each group of near
    copies."""
    return simhash.deduplicate(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, and whether decoding gives the text back."""
    import public_tokenizers

    ranks = byte_bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", no_exact_copies),
    ("SimHash near-dedup", no_near_copies),
    ("benchmark decontamination", no_benchmark),
    ("byte-level BPE", token_ids),
]

#: SQL cannot express the classifier, the fingerprints or the merges; the
#: tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's table is deleted once the next one is
    written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        if before is not None:
            dropped(spark, before)
        before = docs
    return docs
