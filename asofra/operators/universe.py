"""Snapshot days, the universe on each, and companies under several names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import UNKNOWN_SECTOR


def snapshot_dates(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(as_of): the ends of quarters within [start, end]."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    months = F.sequence(F.trunc(first, "quarter"), F.trunc(last, "quarter"), F.expr("INTERVAL 3 MONTHS"))
    starts = spark.range(1).select(F.explode(months).alias("q"))
    return starts.select(F.last_day(F.add_months("q", 2)).alias("as_of")).where(F.col("as_of").between(first, last))


def universe_at(members: DataFrame, history: DataFrame, dates: DataFrame, columns: tuple[str, ...] = ("sector", "industry")) -> DataFrame:
    """(ticker, as_of, columns): the members of each day, with the version of
    their labels that is valid then, or else their first version; without any
    the label is UNKNOWN_SECTOR. Snapshot days are bounded by the calendar,
    so they are broadcast."""
    inside = (F.col("date_added").isNull() | (F.col("date_added") <= F.col("as_of"))) & (
        F.col("date_removed").isNull() | (F.col("date_removed") > F.col("as_of"))
    )
    there = members.join(F.broadcast(dates), inside).select("ticker", "as_of").distinct()
    version = F.struct("valid_from", *columns)
    versions = there.join(history.select("ticker", "valid_from", *columns), "ticker", "left").groupBy("ticker", "as_of").agg(
        F.max(F.when(F.col("valid_from") <= F.col("as_of"), version)).alias("_live"),
        F.min(F.when(F.col("valid_from").isNotNull(), version)).alias("_first"),
    )
    label = F.coalesce("_live", "_first")
    return versions.withColumn("_v", label).select(
        "ticker", "as_of", *(F.coalesce(F.col(f"_v.{c}"), F.lit(UNKNOWN_SECTOR)).alias(c) for c in columns)
    )


def resolve_files(wanted: DataFrame, files: DataFrame, aliases: DataFrame) -> DataFrame:
    """(ticker, cik, file, how): which stored file (ticker, cik) serves a
    listing: its own, else the first sibling's with its cik, else that of the
    ticker it is an alias of (ticker, file). An own file is never shadowed."""
    stored = files.select(F.col("ticker").alias("_file"), F.col("cik").alias("_cik")).distinct()
    own = stored.select(F.col("_file").alias("ticker"), F.col("_cik").alias("cik"), F.col("_file").alias("_own"))
    sibling = stored.groupBy(F.col("_cik").alias("cik")).agg(F.min("_file").alias("_sibling"))
    known = stored.groupBy(F.col("_file").alias("_alias")).agg(F.lit(True).alias("_there"))
    named = aliases.select("ticker", F.col("file").alias("_alias")).join(known, "_alias", "left_semi")
    met = wanted.join(own, ["ticker", "cik"], "left").join(sibling, "cik", "left").join(named, "ticker", "left")
    how = F.when(F.col("_own").isNotNull(), "own").when(F.col("_sibling").isNotNull(), "sibling").when(F.col("_alias").isNotNull(), "alias")
    return met.select("ticker", "cik", F.coalesce("_own", "_sibling", "_alias").alias("file"), how.alias("how"))
