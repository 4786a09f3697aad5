"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def sample(labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` rows (doc_id, label), chosen by a hash of the doc_id.

    Rows without an id or a label are left out, and so is an id whose rows
    disagree on the label; an id counts once.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    agreed = known.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_max")).where("label = _max")
    return agreed.select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of the sampled ids that ``docs`` has, one row an
    id and so at most ``most``: of several texts under one id the least. A
    null text is empty."""
    chosen = F.broadcast(sample(labels, label, most))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").cast("int").alias("label"))
