"""Incremental updates: cursors, tiers, and Structured Streaming jobs."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.splits import fingerprints

WEEK = 7
STATUSES = ("ok", "removed", "needs-backfill", "price-purged")


def due_tiers(today: datetime.date, last_weekly: datetime.date | None, last_monthly: datetime.date | None) -> list[str]:
    """The tiers to run, in order: monthly when the month changed, weekly
    after seven days, daily always."""
    tiers = []
    if last_monthly is None or (today.year, today.month) != (last_monthly.year, last_monthly.month):
        tiers.append("M")
    if last_weekly is None or (today - last_weekly).days >= WEEK:
        tiers.append("W")
    return [*tiers, "D"]


def manifest(roster: DataFrame, facts: DataFrame, prices: DataFrame, daily: DataFrame, splits: DataFrame) -> DataFrame:
    """One row per ticker with its cursors and status, from what is stored."""
    filed = facts.groupBy("ticker").agg(F.max(F.struct("filed", "accession")).alias("_f"))
    filed = filed.select("ticker", F.col("_f.filed").alias("last_filed_date"), F.col("_f.accession").alias("last_filing_accession"))
    priced = prices.groupBy("ticker").agg(F.max("date").alias("last_price_date"))
    done = daily.groupBy("ticker").agg(F.max("date").alias("last_daily_date"))
    out = roster.select("ticker", "date_removed").dropDuplicates(["ticker"])
    for part in (filed, priced, done, fingerprints(splits)):
        out = out.join(part, "ticker", "left")
    status = (
        F.when(F.col("date_removed").isNotNull(), "removed").when(F.col("last_filed_date").isNull(), "needs-backfill")
        .when(F.col("last_price_date").isNull(), "price-purged").otherwise("ok")
    )
    return out.withColumns({"splits_hash": F.coalesce("splits_hash", F.lit("0")), "status": status}).drop("date_removed")


def plan_updates(state: DataFrame, splits: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """(ticker, action, last_daily_date): rebuild where the splits changed,
    else append. Where ``checks`` (ticker, state) says that asking for splits
    failed, nothing is known to be unchanged: hold, which writes neither."""
    now = fingerprints(splits).withColumnRenamed("splits_hash", "_now")
    joined = state.where("status = 'ok'").join(now, "ticker", "left").withColumn("_now", F.coalesce("_now", F.lit("0")))
    action = F.when(F.col("splits_hash") != F.col("_now"), "rebuild").otherwise("append")
    if checks is not None:
        joined = joined.join(checks.select("ticker", F.col("state").alias("_checked")), "ticker", "left")
        action = F.when(F.col("_checked") == "failed", "hold").otherwise(action)
    return joined.select("ticker", action.alias("action"), "last_daily_date")


def fresh_rows(daily: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows to write: all of a rebuilt ticker, the days after the cursor of
    those to append to, none of the others."""
    joined = daily.join(plan, "ticker")
    after = F.col("last_daily_date").isNull() | (F.col("date") > F.col("last_daily_date"))
    wanted = (F.col("action") == "rebuild") | ((F.col("action") == "append") & after)
    return joined.where(wanted).drop("action", "last_daily_date")


def stale_entities(state: DataFrame, index: DataFrame, forms: list[str]) -> DataFrame:
    """(cik, accession, filed): the newest filing of a listed form in the
    filing index where it is not the one that the manifest knows. Listings
    that share a cik are asked once."""
    newest = index.where(F.col("form").isin(*forms)).groupBy("cik").agg(F.max(F.struct("filed", "accession")).alias("_f"))
    asked = state.where("status IN ('ok', 'price-purged') AND cik IS NOT NULL")
    known = asked.groupBy("cik").agg(F.min_by("last_filing_accession", "ticker").alias("_known"))
    met = newest.join(known, "cik").where(~F.col("_f.accession").eqNullSafe(F.col("_known")))
    return met.select("cik", F.col("_f.accession").alias("accession"), F.col("_f.filed").alias("filed"))


def check_manifest(state: DataFrame) -> DataFrame:
    """The manifest, if every ticker stands once and every status is known."""
    bad = state.groupBy("ticker").agg(F.count("*").alias("n"), F.max((~F.col("status").isin(*STATUSES)).cast("int")).alias("odd")).where("n > 1 OR odd = 1")
    if found := bad.limit(5).collect():
        raise ValueError(f"the manifest is wrong at {[r.ticker for r in found]}")
    return state


def stream_layer(spark: SparkSession, source: str, schema, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``apply`` on each batch of new files below ``source``; what was
    read is remembered in ``checkpoint``, so nothing is read twice."""
    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, time: str, value: str, key: str, width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts and sums per window and key; rows later than ``late`` behind
    the watermark are left out of finished windows."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    out = events.withWatermark(time, late).groupBy(window.alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str = "1 hour") -> DataFrame:
    out = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def first_filings(facts: DataFrame, late: str = "400 days") -> DataFrame:
    """(ticker, fiscal_year, filed_at) as a stream: the first filing of a
    year that arrives; an amendment that comes up to ``late`` later does not
    move it. A year's state is dropped once the watermark has passed."""
    timed = facts.select("ticker", "fiscal_year", F.col("filed").cast("timestamp").alias("filed_at")).withWatermark("filed_at", late)
    return timed.dropDuplicatesWithinWatermark(["ticker", "fiscal_year"])
