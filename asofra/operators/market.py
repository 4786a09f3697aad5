"""Prices and splits from several providers, brought to one basis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import splits as splits_

PRICE_COLUMNS = ("open", "high", "low", "close")


def provider_symbol(ticker: Column, renamed: dict[str, str]) -> Column:
    """The provider's name of a ticker: a renamed one by the map; a dot before
    the share class becomes a dash."""
    if not renamed:
        return F.replace(ticker, F.lit("."), F.lit("-"))
    names = F.create_map(*(F.lit(x) for pair in renamed.items() for x in pair))
    return F.replace(F.coalesce(names[ticker], ticker), F.lit("."), F.lit("-"))


def chosen_prices(first: DataFrame, second: DataFrame, blocked: list[str] = ()) -> DataFrame:
    """All rows of a ticker from the first provider that has it, with
    ``source`` 1 or 2. The first is not asked for ``blocked`` tickers, whose
    symbols belong to other companies now. The tickers of the first, one
    short row each, decide; prices of the second move once."""
    own = first.where(~F.col("ticker").isin(*blocked)) if blocked else first
    has = own.select("ticker").distinct()
    rest = second.join(has, "ticker", "left_anti")
    return own.withColumn("source", F.lit(1)).unionByName(rest.withColumn("source", F.lit(2)), allowMissingColumns=True)


def split_events(vendor: DataFrame) -> DataFrame:
    """(ticker, ex_date, ratio) of the true splits among a vendor's daily
    factors (ticker, date, split_factor); an n for 1 split has ratio 1/n.
    Spin-offs and dirty factors are no splits."""
    real = vendor.where(splits_.is_true_split(F.col("split_factor")))
    return real.select("ticker", F.col("date").alias("ex_date"), (1 / F.col("split_factor")).alias("ratio"))


def to_split_adjusted(raw: DataFrame, split_table: DataFrame) -> DataFrame:
    """Prices as traded, put on today's split basis: prices by the factor of
    later splits, volume against it. ``adjusted``, where a row has it, stays;
    else it is the close."""
    out = splits_.with_factor(raw, split_table, "date")
    made = {c: F.col(c) * F.col("factor") for c in PRICE_COLUMNS if c in raw.columns}
    if "volume" in raw.columns:
        made["volume"] = F.col("volume") / F.col("factor")
    close = F.col("close") * F.col("factor")
    made["adjusted"] = F.coalesce("adjusted", close) if "adjusted" in raw.columns else close
    return out.withColumns(made).drop("factor")


def refreshed_splits(cached: DataFrame, fetched: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(splits, states) after asking a provider. ``answers`` (ticker,
    answered) says whom the provider answered.

    Where it did, its events replace the cached ones, unless it has none and
    the cache has some: events do not disappear. state is ``fetched``,
    ``kept`` or, without an answer, ``failed``; a failed ticker is neither
    appended to nor rebuilt.
    """
    has_new = fetched.select("ticker").distinct().withColumn("_new", F.lit(True))
    has_old = cached.select("ticker").distinct().withColumn("_old", F.lit(True))
    met = answers.join(has_new, "ticker", "left").join(has_old, "ticker", "left")
    state = F.when(~F.col("answered"), "failed").when(F.col("_new").isNull() & F.col("_old"), "kept").otherwise("fetched")
    states = met.select("ticker", state.alias("state"))
    new = fetched.join(states.where("state = 'fetched'").select("ticker"), "ticker", "left_semi")
    old = cached.join(states.where("state = 'fetched'").select("ticker"), "ticker", "left_anti")
    return old.unionByName(new), states
