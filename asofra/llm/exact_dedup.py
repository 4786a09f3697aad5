"""Exact dedup by progressive refinement, with DataFrame functions only.

Three filters, each cheaper than the next: rows whose byte length nobody
shares are unique; of the rest, rows whose (length, prefix hash) nobody shares
are unique; only what survives both has its full content hashed and grouped.
The first two filters reach the next scan as bitmaps of a fixed number of
buckets, so their broadcast is bounded. A bucket may hold several keys: it then
lets a unique row through, which the full hash settles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, bitmap, join_groups, marked, scratch, table, without_rows, written

PREFIX_CHARS = 64


def _shared(keyed: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The bitmap of the keys of two rows or more."""
    return bitmap(keyed.groupBy(*keys).count().where("count > 1"), keys, name)


def refine(docs: DataFrame, digest_unique: bool = False) -> DataFrame:
    """Group equal texts; equal means identical after lower-casing A-Z only.

    Returns one row per input row: doc_id, keep_id (the largest doc_id of the
    group), group_size (rows), kept (doc_id is keep_id), text_sha256 (of the
    lower-cased text; null for a row that an earlier stage proved unique,
    unless ``digest_unique``).

    A null text counts as empty. Rows repeated under one doc_id count each
    and share the fate of that doc_id. A null doc_id never wins against
    another; a group of null ids keeps null. An empty table gives no rows.
    Columns besides doc_id and text are ignored.
    """
    return _refined(docs, digest_unique).drop("text_id")


def _refined(docs: DataFrame, digest_unique: bool = False) -> DataFrame:
    """``refine`` with text_id, the xxhash64 of the text as it is."""
    raw = docs.select("doc_id", F.xxhash64("text").alias("text_id"), F.coalesce("text", F.lit("")).alias("_text")).withColumn(
        "_len", F.octet_length("_text")
    )
    same_length = marked(raw, ["_len"], _shared(raw, ["_len"], "_in1"), "_in1", F.lit(True))
    prefixed = same_length.withColumn(
        "_prefix", F.when(F.col("_in1"), F.xxhash64(ascii_lower(F.substring("_text", 1, PREFIX_CHARS))))
    )
    keys = ["_len", "_prefix"]
    same_prefix = marked(prefixed, keys, _shared(prefixed.where("_in1"), keys, "_in2"), "_in2", F.col("_in1"))
    full = F.sha2(F.encode(ascii_lower(F.col("_text")), "UTF-8"), 256)
    hashed = same_prefix.select(
        "doc_id", "text_id", F.col("_in2").alias("_survives"),
        (full if digest_unique else F.when(F.col("_in2"), full)).alias("text_sha256"),
    )
    signed = written(hashed, "exact-dedup")
    left = signed.where("_survives")
    groups = written(
        left.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "exact-groups",
    )
    grouped = join_groups(left, groups, ["text_sha256"], "group_size")
    unique = signed.where("not _survives").select("*", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return unique.unionByName(grouped).select(
        "doc_id", "text_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``refine`` keeps, with all their columns.

    Rows with equal doc_id and equal text all stay or all go. Rows with equal
    doc_id and different texts are told apart by a hash of the text. Only the
    rows that go are joined with the texts.
    """
    with scratch(docs.sparkSession) as keep:
        return without_rows(docs, _refined(docs).where("not kept"), keep)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine(table(spark, sf_dir, "documents"), digest_unique=True)


SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""
