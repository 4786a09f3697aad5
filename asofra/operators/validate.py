"""Coverage, consistency and difference reports."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SECTOR_MASKS, UNKNOWN_SECTOR
from ..functions.kernel import guarded
from .cross_section import MAD_SCALE

GATE_BAND = 1.2


def coverage(rows: DataFrame, values: list[str], group: str | None = None) -> DataFrame:
    """(group, name, n, n_known, percent, tier): how much of each column is
    not null; one pass over the rows."""
    keys = [group] if group else []
    agg = rows.groupBy(*keys).agg(F.count("*").alias("n"), *(F.count(v).alias(v) for v in values))
    long = agg.unpivot([*keys, "n"], values, "name", "n_known")
    percent = guarded(100.0 * F.col("n_known"), F.col("n").cast("double"))
    tier = F.when(F.col("percent") >= 90, "high").when(F.col("percent") >= 50, "medium").otherwise("low")
    return long.withColumn("percent", percent).withColumn("tier", tier)


def concept_grid(facts: DataFrame, companies: DataFrame, concepts: list[str]) -> DataFrame:
    """Every company with every concept, and how many periods it reports. The
    concepts are a constant list, so each company row expands in place."""
    grid = companies.select("ticker", F.explode(F.array(*map(F.lit, concepts))).alias("concept"))
    known = facts.where("value IS NOT NULL").groupBy("ticker", "concept").agg(F.countDistinct("period_end").alias("periods"))
    return grid.join(known, ["ticker", "concept"], "left").withColumn("periods", F.coalesce("periods", F.lit(0)))


def score_checks(scored: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, check, passed): scores center on 0, have a scaled median
    deviation of about 1, stay in bounds and hold no NaN. A check of a group
    without scores is null but for ``present``."""
    middle = scored.groupBy(*groups).agg(
        F.percentile("z", 0.5).alias("m"), F.max(F.abs("z")).alias("top"), F.count(F.when(F.isnan("z"), 1)).alias("nan"), F.count("z").alias("n")
    )
    far = scored.join(middle.select(*groups, "m"), groups).groupBy(*groups).agg(
        (F.lit(MAD_SCALE) * F.percentile(F.abs(F.col("z") - F.col("m")), 0.5)).alias("mad")
    )
    agg = middle.join(far, groups)
    named = {
        "centered": F.abs("m") < 0.05, "scaled": (F.col("mad") > 0.9) & (F.col("mad") < 1.1), "bounded": F.col("top") <= 5,
        "no_nan": F.col("nan") == 0, "present": F.col("n") > 0,
    }
    checks = F.array(*(F.struct(F.lit(n).alias("check"), c.alias("passed")) for n, c in named.items()))
    return agg.select(*groups, F.inline(checks))


def _counted(rows: DataFrame, named: dict[str, Column]) -> DataFrame:
    """(check, failures) of one pass: how many rows fail each condition."""
    agg = rows.agg(*(F.count(F.when(c, 1)).alias(n) for n, c in named.items()))
    return agg.unpivot([], list(named), "check", "failures")


def snapshot_checks(raw: DataFrame, required: list[str], tickers: tuple[int, int] = (100, 600), least_sectors: int = 5) -> DataFrame:
    """(check, passed) of one raw snapshot: a plausible number of companies,
    all ``required`` columns, no ticker twice, no indicator that is null for
    99 of 100 companies, F-scores in range, several sectors, none unknown, and
    each sector's mask fired. An unknown sector has no mask, so one such
    company fails the snapshot."""
    there = [c for c in required if c in raw.columns]
    known = F.count("*")
    sparse = [(F.count(c) <= 0.01 * known).cast("int") for c in there]
    unknown = F.col("sector").isNull() | (F.col("sector") == UNKNOWN_SECTOR)
    named = {
        "ticker_count_plausible": known.between(*tickers),
        "all_columns_present": F.lit(len(there) == len(required)),
        "no_duplicate_tickers": F.countDistinct("ticker") == known,
        "no_99pct_na_indicators": (sum(sparse[1:], sparse[0]) == 0) if sparse else F.lit(True),
        "multiple_sectors": F.countDistinct("sector") >= least_sectors,
        "no_unknown_sector": F.count(F.when(unknown, 1)) == 0,
    }
    if "f_score" in raw.columns:
        named["f_score_range_valid"] = F.count(F.when(~F.col("f_score").between(0, 9), 1)) == 0
    for sector, names in SECTOR_MASKS.items():
        masked = [F.col(n).isNotNull() for n in names if n in raw.columns]
        leak = (F.col("sector") == sector) & functools.reduce(operator.or_, masked, F.lit(False))
        named["mask_fires_" + sector.lower().replace(" ", "_")] = F.count(F.when(leak, 1)) == 0
    agg = raw.agg(*(c.alias(n) for n, c in named.items()))
    return agg.unpivot([], list(named), "check", "passed")


def daily_checks(daily: DataFrame, companies: DataFrame, split_table: DataFrame, least_tickers: int = 100) -> DataFrame:
    """(check, failures, passed) of the daily layer: enough tickers, a sector
    for each, masks on disk, and market values that splits do not move."""
    tickers = daily.select("ticker").distinct().join(companies.select("ticker", "sector"), "ticker", "left")
    few = tickers.agg(F.greatest(F.lit(0), least_tickers - F.count("*")).cast("long").alias("failures")).select(F.lit("tickers_present").alias("check"), "failures")
    missing = _counted(tickers, {"sector_coverage_complete": F.col("sector").isNull() | (F.col("sector") == UNKNOWN_SECTOR)})
    rows = daily.drop("sector", "industry").join(companies.select("ticker", "sector"), "ticker", "left")
    leaks = {}
    for sector, names in SECTOR_MASKS.items():
        masked = [F.col(n).isNotNull() for n in names if n in daily.columns]
        leaks["mask_fires_" + sector.lower().replace(" ", "_")] = (F.col("sector") == sector) & functools.reduce(operator.or_, masked, F.lit(False))
    moved = _counted(split_consistency(daily, split_table), {"split_consistent_market_cap": ~F.col("consistent")})
    found = few.unionByName(missing).unionByName(_counted(rows, leaks)).unionByName(moved)
    return found.withColumn("passed", F.col("failures") == 0)


def build_checks(facts: DataFrame, roster: DataFrame, core: list[str], least_share: float = 0.8) -> DataFrame:
    """(check, failures, passed) of a fundamentals build: every company has
    facts, no vintage is filed before its period ends, none is twice, no value
    is missing, and each core concept covers ``least_share`` of companies."""
    known = facts.select("ticker").distinct()
    absent = roster.select("ticker").distinct().join(known, "ticker", "left_anti").agg(F.count("*").alias("failures"))
    rows = _counted(facts, {"filed_after_period": F.col("filed") < F.col("period_end"), "value_present": F.col("value").isNull() | F.isnan("value")})
    twice = facts.groupBy("ticker", "concept", "period_end", "fiscal_qtr", "accession", "tag").count().where("count > 1").agg(F.count("*").alias("failures"))
    total = known.agg(F.count("*").alias("_n"))
    share = facts.where(F.col("concept").isin(*core) & F.col("value").isNotNull()).groupBy("concept").agg(F.countDistinct("ticker").alias("_k"))
    named = share.sparkSession.createDataFrame([(c,) for c in core], "concept string").join(share, "concept", "left")
    thin = named.join(F.broadcast(total)).where(F.coalesce("_k", F.lit(0)) < least_share * F.col("_n")).agg(F.count("*").alias("failures"))
    found = rows
    for name, frame in (("companies_have_facts", absent), ("vintages_unique", twice), ("core_concepts_covered", thin)):
        found = found.unionByName(frame.select(F.lit(name).alias("check"), "failures"))
    return found.withColumn("passed", F.col("failures") == 0)


def split_consistency(daily: DataFrame, splits: DataFrame, days: int = 14) -> DataFrame:
    """(ticker, ex_date, before, after, consistent): the value nearest before
    and after each split within ``days``; a split must not move it beyond the
    band."""
    own = daily.select("ticker", F.col("date").alias("_d"), F.col("market_cap").alias("_v")).where("market_cap IS NOT NULL")
    gap = F.datediff("_d", "ex_date")
    near = splits.join(own, "ticker").where(gap.between(-days, days))
    agg = near.groupBy("ticker", "ex_date", "ratio").agg(
        F.max_by(F.when(gap < 0, F.col("_v")), F.when(gap < 0, F.col("_d"))).alias("before"),
        F.min_by(F.when(gap >= 0, F.col("_v")), F.when(gap >= 0, F.col("_d"))).alias("after"),
    )
    moved = F.abs(F.log(guarded(F.col("after"), F.col("before"))))
    return agg.withColumn("consistent", moved <= F.log(F.lit(GATE_BAND)))


def difference(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, name, left_value, right_value) of every cell that differs, a
    missing row's cells counting as null."""
    a, b = (t.unpivot(keys, values, "name", v) for t, v in ((left, "left_value"), (right, "right_value")))
    both = a.join(b, [*keys, "name"], "full_outer")
    return both.where(~F.col("left_value").eqNullSafe(F.col("right_value")))
