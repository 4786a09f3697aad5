"""Standardised features per company and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import cross_section as cs


def _wide(scored: DataFrame, keys: list[str], values: list[str], prefix: str) -> DataFrame:
    flat = scored.groupBy(*keys).pivot("name", values).agg(F.first("z"))
    return flat.select(*keys, *(F.col(v).alias(prefix + v) for v in values))


def sector_parts(daily: DataFrame, values: list[str], least_tickers: int = 10) -> tuple[DataFrame, DataFrame]:
    """What a day settles by itself: the places within the sector (ticker,
    date, cs_sec_) and the sector medians (date, sector)."""
    logged = cs.log_levels(daily)
    long = cs.melt(logged, ["ticker", "date", "sector"], values)
    within = _wide(cs.sector_scores(long, ["date", "sector", "name"]), ["ticker", "date"], values, "cs_sec_")
    return within, cs.medians(logged, values, ["date", "sector"], "date", "ticker", least_tickers)


def join_parts(daily: DataFrame, within: DataFrame, middles: DataFrame, values: list[str], passthrough: list[str] = (), window: int = 1260, least: int = 252) -> DataFrame:
    """Features from a day's parts and the histories that they continue."""
    long = cs.melt(cs.log_levels(daily), ["ticker", "date"], values)
    own = _wide(cs.rolling_scores(long, ["ticker", "name"], "date", "value", window, least), ["ticker", "date"], values, "ts_own_")
    sector_long = cs.melt(middles, ["date", "sector"], values)
    sector = _wide(cs.rolling_scores(sector_long, ["sector", "name"], "date", "value", window, least), ["date", "sector"], values, "ts_sec_")
    base = daily.select("ticker", "date", "sector", *passthrough)
    return base.join(own, ["ticker", "date"], "left").join(sector, ["date", "sector"], "left").join(within, ["ticker", "date"], "left")


def assemble(daily: DataFrame, values: list[str], passthrough: list[str] = (), window: int = 1260, least: int = 252, least_tickers: int = 10) -> DataFrame:
    """Per company and day: own history (ts_own_), the sector's history of
    medians (ts_sec_), the place within the sector that day (cs_sec_), and
    ``passthrough`` as it is.

    The three kinds of score share one long table, so one job standardises
    all values; they meet by keys in left joins.
    """
    within, middles = sector_parts(daily, values, least_tickers)
    return join_parts(daily, within, middles, values, passthrough, window, least)


def advanced_parts(daily: DataFrame, within: DataFrame, middles: DataFrame, values: list[str], least_tickers: int = 10) -> tuple[DataFrame, DataFrame]:
    """The rows to append to stored parts: those of days after the last day
    that has sector medians. Earlier days never change."""
    cursor = middles.agg(F.max("date").alias("_last"))
    fresh = daily.join(F.broadcast(cursor), F.col("_last").isNull() | (F.col("date") > F.col("_last"))).drop("_last")
    return sector_parts(fresh, values, least_tickers)
