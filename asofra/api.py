"""Functions and verbs for users of the stored layers.

    python -m asofra.api build DIR              facts, prices, splits, companies -> fund, daily, manifest
    python -m asofra.api update DIR [DAY]       the tiers that are due: new filings, new days, changed splits
    python -m asofra.api ticker DIR T           print a ticker's series
    python -m asofra.api features build DIR     daily -> features and the parts they grow from
    python -m asofra.api features update DIR    append the days after the last one
    python -m asofra.api demo DIR T [FAMILY..]  one company's facts, indicators and last day
"""

from __future__ import annotations

import datetime
import sys
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import PASSTHROUGH, PERSHARE_FORMS, STANDARDIZED, indicator_names
from .functions.storage import written
from .operators import daily as daily_
from .operators import features as features_
from .operators import periods, quarterly, snapshot, splits, universe, vintages
from .operators.reference_data import attach_dimension
from .sources import files
from .streaming import incremental

#: All fundamentals, and what the cross-section is finalised from.
CARRIED = [*daily_.FUNDAMENTAL, "ing_rev_lag1", "ing_rev_lag2"]

get_indicator_names = indicator_names


def layer(spark: SparkSession, root: str, name: str) -> DataFrame:
    return files.read_layer(spark, f"{root}/{name}")


def stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A layer, or None if it has not been written."""
    try:
        return layer(spark, root, name)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return None


def get_fundamentals(
    facts: DataFrame, ticker: str | None = None, as_of: str | None = None, vintages_: bool = False, allow_restated: bool = False,
    cik: str | None = None, aliases: DataFrame | None = None,
) -> DataFrame:
    """A company's facts as of a day, by ticker or cik. Without a day the call
    is an error, unless all vintages or restated values are asked for. A
    ticker without facts of its own is served by a sibling with its ``cik``,
    or by the file that ``aliases`` (ticker, file) names."""
    if cik is not None:
        rows = facts.where(F.col("cik") == F.lpad(F.lit(cik), 10, "0"))
        if ticker is not None:
            asked = facts.sparkSession.createDataFrame([(ticker, cik.zfill(10))], "ticker string, cik string")
            none = facts.sparkSession.createDataFrame([], "ticker string, file string")
            served = universe.resolve_files(asked, facts.select("ticker", "cik").distinct(), none if aliases is None else aliases)
            rows = facts.join(served.select(F.col("file").alias("ticker")), "ticker", "left_semi")
    else:
        rows = facts.where(F.col("ticker") == ticker)
    if vintages_:
        return rows
    if as_of is None and not allow_restated:
        raise ValueError("give as_of, or ask for vintages or restated values: the latest values look ahead")
    day = F.lit(as_of).cast("date") if as_of else F.lit("9999-12-31").cast("date")
    return vintages.as_of_view(rows, day)


def load_ticker_timeseries(spark: SparkSession, root: str, ticker: str, start: str | None = None, end: str | None = None) -> DataFrame:
    rows = layer(spark, root, "daily").where(F.col("ticker") == ticker)
    if start:
        rows = rows.where((F.col("date") >= F.lit(start).cast("date")) & (F.col("year") >= int(start[:4])))
    if end:
        rows = rows.where((F.col("date") <= F.lit(end).cast("date")) & (F.col("year") <= int(end[:4])))
    return rows.orderBy("date")


def load_daily_cross_section(spark: SparkSession, root: str, day: str, zscore: bool = False) -> DataFrame:
    """One day of all companies, finalised and masked; with ``zscore`` robust
    scores in place of the values."""
    rows = layer(spark, root, "daily").where(F.col("year") == int(day[:4])).drop("year")
    return daily_.cross_section(rows, day, layer(spark, root, "companies"), zscore)


def list_timeseries_tickers(spark: SparkSession, root: str) -> DataFrame:
    return layer(spark, root, "daily").select("ticker").distinct()


def list_dates(spark: SparkSession, root: str) -> DataFrame:
    return layer(spark, root, "daily").select("date").distinct()


def build_historical_snapshots(spark: SparkSession, root: str, start: str, end: str, refresh: bool = False) -> None:
    """Raw and scored snapshots of every quarter's end within [start, end];
    days that are stored stay, unless ``refresh``. Layers members and history
    give each day's universe and labels."""
    dates = universe.snapshot_dates(spark, start, end)
    done = stored(spark, root, "snapshot_raw")
    if done is not None and not refresh:
        dates = files.missing(dates, done.select("as_of").distinct(), ["as_of"])
    tables = [layer(spark, root, n) for n in ("facts", "prices", "splits", "members", "history")]
    raw = written(snapshot.finalize(snapshot.assemble_universe(*tables, written(dates, "dates"))), "snapshot")
    files.write_partitions(raw, f"{root}/snapshot_raw", "as_of")
    files.write_partitions(snapshot.scores(raw, indicator_names()).drop("value"), f"{root}/snapshot_zscore", "as_of")


def load_snapshot(spark: SparkSession, root: str, day: str, kind: str = "raw") -> DataFrame | None:
    """The ``raw`` or ``zscore`` snapshot of a day; None if there is none."""
    if kind not in ("raw", "zscore"):
        raise ValueError("kind is raw or zscore")
    found = stored(spark, root, f"snapshot_{kind}")
    rows = None if found is None else found.where(F.col("as_of") == F.lit(day).cast("date"))
    return None if rows is None or rows.isEmpty() else rows


def load_history(spark: SparkSession, root: str, before: str) -> DataFrame:
    """All raw snapshots before a day."""
    return layer(spark, root, "snapshot_raw").where(F.col("as_of") < F.lit(before).cast("date"))


def list_snapshots(spark: SparkSession, root: str) -> DataFrame:
    return layer(spark, root, "snapshot_raw").select("as_of").distinct()


def _features_input(spark: SparkSession, root: str) -> tuple[DataFrame, list[str], list[str]]:
    rows = attach_dimension(layer(spark, root, "daily").drop("year", "sector", "industry"), layer(spark, root, "companies"))
    there = set(rows.columns)
    return rows, [n for n in STANDARDIZED if n in there], [n for n in PASSTHROUGH if n in there]


def _join_features(spark: SparkSession, root: str, window: int, least: int) -> None:
    rows, values, passthrough = _features_input(spark, root)
    out = features_.join_parts(rows, layer(spark, root, "cs_sec").drop("year"), layer(spark, root, "sector_medians").drop("year"), values, passthrough, window, least)
    files.write_partitions(written(out.withColumn("year", F.year("date")), "features"), f"{root}/features", "year")


def build_all_features(spark: SparkSession, root: str, window: int = 1260, least: int = 252, least_tickers: int = 10) -> None:
    """Standardise the whole daily layer: the parts of each day, and features."""
    rows, values, _ = _features_input(spark, root)
    for name, part in zip(("cs_sec", "sector_medians"), features_.sector_parts(rows, values, least_tickers)):
        files.write_partitions(part.withColumn("year", F.year("date")), f"{root}/{name}", "year")
    _join_features(spark, root, window, least)


def update_features(spark: SparkSession, root: str, window: int = 1260, least: int = 252, least_tickers: int = 10) -> int:
    """Append the parts of days after the last one, rebuild the series, and
    return the number of rows that places within sectors gained."""
    rows, values, _ = _features_input(spark, root)
    old = [layer(spark, root, n).drop("year") for n in ("cs_sec", "sector_medians")]
    fresh = [written(p.withColumn("year", F.year("date")), "parts") for p in features_.advanced_parts(rows, *old, values, least_tickers)]
    added = files.append_rows(spark, fresh[0], f"{root}/cs_sec", ["ticker", "date"], "year")
    files.append_rows(spark, fresh[1], f"{root}/sector_medians", ["date", "sector"], "year")
    if added:
        _join_features(spark, root, window, least)
    return added


def load_features(spark: SparkSession, root: str, day: str | None = None, ticker: str | None = None) -> DataFrame:
    """Features of a day, of a ticker, or both."""
    rows = layer(spark, root, "features")
    if day:
        rows = rows.where((F.col("year") == int(day[:4])) & (F.col("date") == F.lit(day).cast("date")))
    return rows.where(F.col("ticker") == ticker) if ticker else rows


def _funds(facts: DataFrame, cuts: DataFrame, companies: DataFrame) -> tuple[DataFrame, DataFrame]:
    return daily_.fund_layer(facts, cuts, companies), quarterly.quarter_layer(facts, cuts, companies)


def _daily(spark: SparkSession, root: str, prices: DataFrame) -> DataFrame:
    """The daily rows of ``prices``; other layers are read for its tickers."""
    own = prices.select("ticker").distinct()
    facts, cuts, fund, quarters = (layer(spark, root, n).join(own, "ticker", "left_semi") for n in ("facts", "splits", "fund", "quarters"))
    eps = facts.where("concept = 'eps_diluted'").join(splits.split_table(cuts), "ticker", "left")
    eps = eps.withColumn("value", F.col("value") * splits.factor_after(F.col("splits"), F.col("filed"))).drop("splits")
    rows = daily_.daily_layer(prices, fund, daily_.pershare_layer(facts), cuts, CARRIED, periods.ttm_eps(eps, ["ticker"]), quarters)
    return rows.withColumn("year", F.year("date"))


def _roster(spark: SparkSession, root: str) -> DataFrame:
    members = stored(spark, root, "members")
    if members is not None:
        return members
    return layer(spark, root, "companies").select("ticker", F.lit(None).cast("date").alias("date_removed"))


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    tables = [layer(spark, root, n) for n in ("facts", "prices", "daily", "splits")]
    return incremental.check_manifest(incremental.manifest(_roster(spark, root), *tables))


def _save(df: DataFrame, path: str) -> None:
    """Replace a layer that ``df`` may have been read from."""
    written(df, "layer").write.mode("overwrite").parquet(path)


def build_timeseries(spark: SparkSession, root: str) -> None:
    """Build the fund, quarter and daily layers of all tickers, and the
    manifest of what they hold."""
    fund, quarters = _funds(*(layer(spark, root, n) for n in ("facts", "splits", "companies")))
    fund.write.mode("overwrite").parquet(f"{root}/fund")
    quarters.write.mode("overwrite").parquet(f"{root}/quarters")
    files.write_partitions(_daily(spark, root, layer(spark, root, "prices")), f"{root}/daily", "year")
    _save(_manifest(spark, root), f"{root}/manifest")


def refresh_funds(spark: SparkSession, root: str) -> int:
    """Rebuild the fund and quarter rows of the tickers that have filed since
    the manifest was written; returns their number. Days already written
    stay: they used what was public then."""
    facts, state = layer(spark, root, "facts"), layer(spark, root, "manifest")
    newest = facts.where(F.col("form").isin(*PERSHARE_FORMS)).groupBy("ticker").agg(F.max("filed").alias("_newest"))
    known = state.select("ticker", "last_filed_date")
    late = newest.join(known, "ticker", "left").where(F.col("last_filed_date").isNull() | (F.col("_newest") > F.col("last_filed_date")))
    late = written(late.select("ticker"), "late")
    if count := late.count():
        fresh = _funds(facts.join(late, "ticker", "left_semi"), layer(spark, root, "splits"), layer(spark, root, "companies"))
        for name, rows in zip(("fund", "quarters"), fresh):
            _save(layer(spark, root, name).join(late, "ticker", "left_anti").unionByName(rows), f"{root}/{name}")
    return count


def update_all_daily(spark: SparkSession, root: str, checks: DataFrame | None = None) -> int:
    """Advance the daily layer; returns the number of new days of companies.

    Only days after a ticker's cursor are priced and joined. A ticker whose
    splits changed is on a new basis: its rows are rebuilt, and the partitions
    that hold them replaced. One for which asking for splits failed
    (``checks``: ticker, state) is held.
    """
    state, cuts = layer(spark, root, "manifest"), layer(spark, root, "splits")
    new = layer(spark, root, "prices").select("ticker").distinct().join(state, "ticker", "left_anti")
    plan = incremental.plan_updates(state, cuts, checks).unionByName(
        new.select("ticker", F.lit("append").alias("action"), F.lit(None).cast("date").alias("last_daily_date"))
    )
    plan = written(plan, "plan")
    days = written(incremental.fresh_rows(layer(spark, root, "prices"), plan), "days")
    fresh = written(_daily(spark, root, days), "fresh-daily")
    rebuilt = written(plan.where("action = 'rebuild'").select("ticker"), "rebuilt")
    added = files.append_rows(spark, fresh.join(rebuilt, "ticker", "left_anti"), f"{root}/daily", ["ticker", "date"], "year")
    if not rebuilt.isEmpty():
        old = layer(spark, root, "daily")
        years = fresh.join(rebuilt, "ticker", "left_semi").select("year").union(old.join(rebuilt, "ticker", "left_semi").select("year")).distinct()
        kept = old.join(rebuilt, "ticker", "left_anti").join(years, "year", "left_semi")
        again = fresh.join(rebuilt, "ticker", "left_semi")
        added += again.join(old.select("ticker", "date"), ["ticker", "date"], "left_anti").count()
        files.write_partitions(written(kept.unionByName(again), "rebuilt-daily"), f"{root}/daily", "year")
    return added


def run_incremental_update(spark: SparkSession, root: str, today: str | None = None, checks: DataFrame | None = None) -> int:
    """Run the tiers that are due: monthly the snapshots of ended quarters,
    weekly the fund layers of companies with new filings, daily the new days.
    The tiers' own days, the manifest and a log row are stored. Returns the
    number of new days of companies; running twice adds nothing."""
    day = datetime.date.fromisoformat(today) if today else datetime.date.today()
    began, marks = time.time(), stored(spark, root, "watermarks")
    last = {r.tier: r.day for r in marks.collect()} if marks is not None else {}
    tiers, snapshots, refreshed = incremental.due_tiers(day, last.get("W"), last.get("M")), 0, 0
    if stored(spark, root, "manifest") is None:
        _save(_manifest(spark, root), f"{root}/manifest")
    if "M" in tiers and stored(spark, root, "members") is not None and (done := stored(spark, root, "snapshot_raw")) is not None:
        start = done.agg(F.max("as_of")).first()[0]
        build_historical_snapshots(spark, root, str(start), str(day))
        snapshots = list_snapshots(spark, root).where(F.col("as_of") > F.lit(start)).count()
    if "W" in tiers:
        refreshed = refresh_funds(spark, root)
    added = update_all_daily(spark, root, checks)
    held = None if checks is None else checks.where("state = 'failed'").select("ticker")
    state = _manifest(spark, root)
    if held is not None:
        # a held ticker's splits are unchecked: its old fingerprint stays
        old = layer(spark, root, "manifest").join(held, "ticker", "left_semi").select("ticker", F.col("splits_hash").alias("_old"))
        state = state.join(old, "ticker", "left").withColumn("splits_hash", F.coalesce("_old", "splits_hash")).drop("_old")
    _save(state, f"{root}/manifest")
    _save(spark.createDataFrame([(t, d) for t, d in (last | dict.fromkeys(tiers, day)).items()], "tier string, day date"), f"{root}/watermarks")
    log = [(str(day), "".join(tiers), added, refreshed, snapshots, round((time.time() - began) / 60, 3))]
    files.append_log(spark.createDataFrame(log, "as_of string, tiers string, days_added long, tickers_refreshed long, snapshots long, minutes double").coalesce(1), f"{root}/log")
    return added


def demo_ticker(spark: SparkSession, root: str, ticker: str, families: list[str] | None = None, start: str | None = None) -> DataFrame:
    """The last day of a ticker in long form (family's indicator, value): what
    the layers hold of one company, with nothing known too early."""
    rows = load_ticker_timeseries(spark, root, ticker, start)
    there = [n for n in indicator_names(families) if n in rows.columns]
    last = rows.orderBy(F.col("date").desc()).limit(1)
    return last.unpivot(["ticker", "date", "fiscal_year", "filed_date"], there, "indicator", "value")


def main(args: list[str]) -> None:
    verbs = {"build": build_timeseries, "update": run_incremental_update}
    made = {"build": build_all_features, "update": update_features}
    if len(args) < 2 or args[0] not in (*verbs, "ticker", "features", "demo") or (args[0] == "features" and (len(args) < 3 or args[1] not in made)):
        raise SystemExit(__doc__)
    spark = SparkSession.builder.appName("asofra").getOrCreate()
    if args[0] in verbs:
        print(verbs[args[0]](spark, *args[1:]))
    elif args[0] == "features":
        print(made[args[1]](spark, args[2]))
    elif args[0] == "demo":
        demo_ticker(spark, args[1], args[2], args[3:] or None).show(200, truncate=False)
    else:
        load_ticker_timeseries(spark, *args[1:]).show(50, truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
