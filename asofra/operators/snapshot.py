"""From as-of views to one wide row and one row of indicators per company.

``keys`` name a company at a point of view: (ticker,) for one date, (ticker,
as_of) for many at once. Nothing loops over companies or dates.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import FAMILIES, SHARES_TAGS
from ..functions.kernel import growth, guarded
from ..functions.storage import written
from . import asof, cross_section, periods, splits, vintages
from .indicators import CONCEPTS, derived, formulas, masked, statutory_rate
from .universe import universe_at

LAG_PREFIX = {1: "p_", 2: "l2_", 3: "l3_", 4: "l4_", 5: "l5_"}
YEAR = 365.25
LAG_TOLERANCE = 135
#: Days after the year's end in which its share count may be dated.
SHARES_WINDOW = 120


def with_derived(wide: DataFrame) -> DataFrame:
    for layer in derived():
        wide = wide.withColumns({name: F.expr(text) for name, text in layer.items()})
    return wide


def annual_rows(view: DataFrame, keys: list[str]) -> DataFrame:
    """Annual rows by period end, with the derived quantities."""
    return with_derived(vintages.by_period(view, CONCEPTS, keys))


def wide_rows(view: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Current year under c_, five years back under p_, l2_ ... l5_.

    ``targets`` has the keys and the fiscal_year. The current row is that of
    the year's label; earlier rows are found by date, so a changed label or
    year end does not misplace them. They end nearest to k years before the
    year's balance sheet, within LAG_TOLERANCE days.
    """
    rows = annual_rows(view, keys).drop("fiscal_year")
    sheets = view.where("concept = 'total_assets' AND fiscal_qtr = 'FY' AND value IS NOT NULL")
    anchor = sheets.groupBy(*keys, "fiscal_year").agg(F.max("period_end").alias("anchor"))
    label = with_derived(vintages.pivot(view.where("fiscal_qtr = 'FY'"), CONCEPTS, keys)).drop("period_type")
    ends = view.where("fiscal_qtr = 'FY'").groupBy(*keys, "fiscal_year").agg(F.max("period_end").alias("period_end"), F.max("filed").alias("filed"))
    label = label.join(ends, [*keys, "fiscal_year"])
    now = label.select(*keys, "fiscal_year", *(F.col(c).alias(f"c_{c}") for c in label.columns if c not in (*keys, "fiscal_year")))
    steps = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(round(k * YEAR)).alias("back")) for k in LAG_PREFIX))).alias("s")
    asked = targets.select(*keys, "fiscal_year").join(anchor, [*keys, "fiscal_year"]).select("*", steps).select(
        *keys, "fiscal_year", "s.k", F.date_sub("anchor", F.col("s.back")).alias("_at")
    )
    found = asof.nearest(asked, sheets.select(*keys, "period_end").distinct(), keys, "_at", "period_end", LAG_TOLERANCE, ["period_end"])
    lags = found.withColumnRenamed("near_period_end", "period_end").join(rows, [*keys, "period_end"])
    fields = [c for c in rows.columns if c not in keys]
    side = lags.groupBy(*keys, "fiscal_year").agg(*(F.max(F.when(F.col("k") == k, F.struct(*fields))).alias(f"_{k}") for k in LAG_PREFIX))
    flat = side.select(*keys, "fiscal_year", *(F.col(f"_{k}.{c}").alias(x + c) for k, x in LAG_PREFIX.items() for c in fields))
    out = targets.join(now, [*keys, "fiscal_year"]).join(anchor, [*keys, "fiscal_year"], "left")
    return out.join(flat, [*keys, "fiscal_year"], "left")


def year_shares(view: DataFrame, dated: DataFrame, keys: list[str], end: str) -> DataFrame:
    """``dated`` with shares and shares_filed: the earliest count dated within
    SHARES_WINDOW days after ``end``, of the most preferred tag."""
    counts = view.where("concept = 'shares_outstanding' AND fiscal_qtr = 'FY' AND value IS NOT NULL").select(
        *keys, F.col("period_end").alias("_pe"), F.col("value").alias("_v"), F.col("filed").alias("_f"), F.col("tag").alias("_t")
    )
    rank = F.lit(len(SHARES_TAGS))
    for k, tag in reversed(list(enumerate(SHARES_TAGS))):
        rank = F.when(F.col("_t") == tag, k).otherwise(rank)
    inside = F.datediff("_pe", end).between(0, SHARES_WINDOW)
    best = F.min(F.when(inside, F.struct(rank.alias("r"), "_pe", "_v", "_f")))
    own = dated.columns
    joined = dated.join(counts, keys, "left").groupBy(*own).agg(best.alias("_b"))
    return joined.select(*own, F.col("_b._v").alias("shares"), F.col("_b._f").alias("shares_filed"))


def share_counts(view: DataFrame, wide: DataFrame, split_table: DataFrame, keys: list[str]) -> DataFrame:
    """Add shares_0, shares_1, shares_5 and the split ratios between their
    filings, ratio_1 and ratio_5."""
    base = wide.select(*keys, F.explode(F.array(*(
        F.struct(F.lit(k).alias("k"), end.alias("end")) for k, end in ((0, F.col("anchor")), (1, F.col("p_period_end")), (5, F.col("l5_period_end")))
    ))).alias("s")).select(*keys, "s.*").where("end IS NOT NULL")
    found = year_shares(view, base, keys, "end")
    side = found.groupBy(*keys).agg(*(
        F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}_{k}") for k in (0, 1, 5) for c in ("shares", "shares_filed")
    ))
    out = wide.join(side, keys, "left").join(splits.split_table(split_table), "ticker", "left")
    for k in (1, 5):
        out = out.withColumn(f"ratio_{k}", splits.factor_between(F.col("splits"), F.col(f"shares_filed_{k}"), F.col("shares_filed_0")))
    return out


def quarter_features(view: DataFrame, split_table: DataFrame, keys: list[str], wide: DataFrame) -> DataFrame:
    """(keys, q_...): the indicators that need standalone quarters."""
    net, rev = (written(periods.flow_quarters(view, c, keys), c) for c in ("net_income", "revenue"))
    tax, at = periods.flow_quarters(view, "income_tax_expense", keys), written(periods.instants(view, "total_assets", keys), "assets")
    joined = view.where("concept = 'eps_diluted'").join(splits.split_table(split_table), "ticker", "left")
    adjusted = joined.withColumn("value", F.col("value") * splits.factor_after(F.col("splits"), F.col("filed"))).drop("splits")
    eps = periods.flow_quarters(adjusted, "eps_diluted", keys)
    sheet = at.select(*keys, F.col("qend").alias("at_end"), F.col("value").alias("at"))

    def latest(rows: DataFrame, days: int, tolerance: int) -> DataFrame:
        """The last quarter with the one ``days`` before and its assets."""
        back = periods.lagged(rows.select(*keys, "qend", "value"), keys, "qend", days, tolerance, ["qend", "value"])
        last = back.join(periods.last_quarter(rows, keys), [*keys, "qend"])
        return asof.nearest(last, sheet, keys, "near_qend", "at_end", periods.ANCHOR_TOLERANCE, ["at"])

    out = wide.select(*keys)
    month = latest(tax, periods.YEAR_DAYS, periods.YEAR_TOLERANCE)
    out = out.join(month.select(*keys, guarded(F.col("value") - F.col("near_value"), F.col("near_at")).alias("q_ch_tax")), keys, "left")
    quarter = latest(net, 91, periods.LAG_TOLERANCE)
    out = out.join(quarter.select(*keys, guarded(F.col("value"), F.col("near_at")).alias("q_roaq")), keys, "left")
    sales = latest(rev, 91, periods.LAG_TOLERANCE)
    out = out.join(sales.select(*keys, growth(F.col("value"), F.col("near_value")).alias("q_revenue_growth_qoq")), keys, "left")
    out = out.join(periods.increase_streak(net, keys).withColumnRenamed("streak", "q_num_earn_increase"), keys, "left")
    out = out.join(periods.seasonal_surprise(eps, keys, 1e-10).withColumnRenamed("surprise", "q_earnings_surprise"), keys, "left")
    per_share = quarter_shares(view, rev, split_table, keys)
    per_share = per_share.withColumn("value", F.when(F.col("shares") > 0, F.col("value") / F.col("shares"))).drop("shares")
    out = out.join(periods.seasonal_surprise(per_share, keys, 1e-8).withColumnRenamed("surprise", "q_revenue_surprise"), keys, "left")
    out = out.join(earnings_consistency(adjusted, wide, keys), keys, "left")
    out = out.join(volatility(net, rev, sheet, wide, keys), keys, "left")
    return out.join(cash_flow_stability(view, keys), keys, "left")


def quarter_shares(view: DataFrame, quarters: DataFrame, split_table: DataFrame, keys: list[str]) -> DataFrame:
    """Quarters with shares on today's basis: the preferred count dated up to
    75 days after the quarter, over the split factor since its filing."""
    counts = view.where("concept = 'shares_outstanding' AND value IS NOT NULL").select(
        *keys, F.col("period_end").alias("_pe"), F.col("filed").alias("_f"), F.col("value").alias("_v"), F.col("tag").alias("_t")
    )
    rank = F.lit(len(SHARES_TAGS))
    for k, tag in reversed(list(enumerate(SHARES_TAGS))):
        rank = F.when(F.col("_t") == tag, k).otherwise(rank)
    inside = F.datediff("_pe", "qend").between(0, 75)
    best = F.min(F.when(inside, F.struct(rank.alias("r"), "_pe", "_f", "_v"))).alias("_b")
    found = quarters.select(*keys, "qend", "value").join(counts, keys, "left").groupBy(*keys, "qend", "value").agg(best)
    based = found.join(splits.split_table(split_table), "ticker", "left")
    return based.select(*keys, "qend", "value", (F.col("_b._v") / splits.factor_after(F.col("splits"), F.col("_b._f"))).alias("shares"))


def earnings_consistency(adjusted: DataFrame, wide: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, q_earnings_consistency): mean of up to five annual growths on
    the mean size of the two years before; null where growth changes sign or
    earnings leap more than sixfold."""
    years = periods.period_rows(adjusted, "eps_diluted", keys).where("kind = 'FY'").groupBy(*keys, F.col("period_end").alias("pe")).agg(F.max("value").alias("value"))
    enough = years.groupBy(*keys).agg(F.count("*").alias("n")).where("n >= 3").select(*keys)
    one = asof.lagged(years, keys, "pe", round(YEAR), 35, ["value"]).withColumnRenamed("near_value", "e1")
    both = asof.lagged(one, keys, "pe", round(2 * YEAR), 35, ["value"]).withColumnRenamed("near_value", "e2")
    size = (F.abs("e1") + F.abs("e2")) / 2
    grown = both.withColumn("g", guarded(F.col("value") - F.col("e1"), size))
    at = asof.nearest(wide.select(*keys, "anchor").where("anchor IS NOT NULL"), grown.select(*keys, "pe"), keys, "anchor", "pe", 10, ["pe"])
    steps = F.explode(F.array(*(F.struct(F.lit(m).alias("m"), F.lit(round(m * YEAR)).alias("back")) for m in range(5)))).alias("s")
    asked = at.where("near_pe IS NOT NULL").select(*keys, F.col("near_pe").alias("target"), steps).select(*keys, "target", "s.m", F.date_sub("target", F.col("s.back")).alias("_at"))
    got = asof.nearest(asked, grown, keys, "_at", "pe", 35, ["g", "value", "e1"])

    def of(m: int, c: str) -> Column:
        return F.max(F.when(F.col("m") == m, F.col(f"near_{c}")))

    agg = got.groupBy(*keys).agg(F.avg("near_g").alias("mean"), of(0, "g").alias("g0"), of(1, "g").alias("g1"), of(0, "value").alias("e0"), of(0, "e1").alias("e1"))
    leap = F.coalesce(F.abs(F.col("e0")) > 6 * F.abs(F.col("e1")), F.lit(False))
    turned = F.coalesce((F.col("g0") > 0) & (F.col("g1") < 0), F.lit(False)) | F.coalesce((F.col("g0") < 0) & (F.col("g1").isNull() | (F.col("g1") > 0)), F.lit(False))
    value = F.when(F.col("e1").isNotNull() & ~leap & ~turned, F.col("mean"))
    return agg.join(enough, keys, "left_semi").select(*keys, value.alias("q_earnings_consistency"))


def volatility(net: DataFrame, rev: DataFrame, sheet: DataFrame, wide: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, q_ms_roa_vol, q_ms_rev_vol): deviations over the quarters of
    the 1415 days up to the year's end, with six values at least."""
    ends = wide.select(*keys, F.col("c_period_end").alias("_end"))

    def deviation(rows: DataFrame, name: str) -> DataFrame:
        inside = rows.join(ends, keys).where((F.col("qend") > F.date_sub("_end", 1415)) & (F.col("qend") <= F.col("_end")))
        agg = inside.groupBy(*keys).agg(F.stddev_samp("x").alias("sd"), F.count("x").alias("n"))
        return agg.select(*keys, F.when(F.col("n") >= 6, F.col("sd")).alias(name))

    on = asof.nearest(net.select(*keys, "qend", "value"), sheet, keys, "qend", "at_end", periods.ANCHOR_TOLERANCE, ["at"])
    roa = on.withColumn("x", guarded(F.col("value"), F.col("near_at")))
    back = asof.lagged(rev.select(*keys, "qend", "value"), keys, "qend", periods.YEAR_DAYS, periods.YEAR_TOLERANCE, ["value"])
    sales = back.withColumn("x", guarded(F.col("value"), F.col("near_value")))
    return wide.select(*keys).join(deviation(roa, "q_ms_roa_vol"), keys, "left").join(deviation(sales, "q_ms_rev_vol"), keys, "left")


def cash_flow_stability(view: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, q_fcf_stability): deviation of standalone operating cash flow
    over assets, by label, of the last sixteen quarters, eight at least."""
    pick = F.struct("period_end", "filed", "accession")
    rows = view.where("concept IN ('operating_cashflow', 'total_assets') AND fiscal_qtr IN ('Q1', 'Q2', 'Q3', 'Q4')")
    cfo, at = F.col("concept") == "operating_cashflow", F.col("concept") == "total_assets"
    wide = rows.groupBy(*keys, "fiscal_year", F.col("fiscal_qtr").alias("period_type")).agg(
        F.max_by(F.when(cfo, F.col("value")), F.when(cfo, pick)).alias("operating_cashflow"),
        F.max_by(F.when(cfo, F.datediff("period_end", "period_start")), F.when(cfo, pick)).alias("period_days"),
        F.max_by(F.when(at, F.col("value")), F.when(at, pick)).alias("total_assets"),
    )
    done = periods.decumulate(wide, keys).where("total_assets > 0").withColumn("x", F.col("standalone") / F.col("total_assets"))
    order = F.concat(F.col("fiscal_year").cast("string"), F.col("period_type"))
    return periods.trailing_deviation(done.withColumn("qend", order), keys, "x").withColumnRenamed("deviation", "q_fcf_stability")


def tax_rate() -> Column:
    """The statutory rate of the current year."""
    return F.expr(statutory_rate("unix_date(c_period_end)", "unix_date(date_add(c_period_end, -364))"))


def indicator_rows(wide: DataFrame, keep: Iterable[str], sector: str | None = "sector") -> DataFrame:
    """All indicators of a wide row that also has price, sector, share counts
    and quarter features; composites of the cross-section still as the
    company's own ingredient."""
    priced = wide.withColumn("market_cap", F.col("price") * F.col("c_shares_outstanding")).withColumn("tax_rate", tax_rate())
    made = {n: F.expr(masked(n, f"({e})", sector) if sector else e) for n, e in formulas().items()}
    lags = (F.col("p_revenue").alias("ing_rev_lag1"), F.col("l2_revenue").alias("ing_rev_lag2"))
    return priced.select(*keep, *(made[n].alias(n) for n in made), *lags)


def assemble_universe(facts: DataFrame, prices: DataFrame, split_table: DataFrame, members: DataFrame, history: DataFrame, dates: DataFrame) -> DataFrame:
    """``assemble`` for the members of each date, with the sector and
    industry that were valid then."""
    there = written(universe_at(members, history, dates), "universe")
    own = facts.join(there.select("ticker").distinct(), "ticker", "left_semi")
    return assemble(own, prices, split_table, there, dates)


def assemble(facts: DataFrame, prices: DataFrame, split_table: DataFrame, companies: DataFrame, dates: DataFrame) -> DataFrame:
    """Point-in-time indicator rows for every (ticker, as_of) of the dates.

    ``companies`` (ticker, sector, industry) may have as_of as well: then it
    says who belongs to a date, and with which labels.
    Vintages are compressed to the days on which each one wins before they
    meet the dates, so a date gets the rows of its view and no others. The
    newest annual filing is the year, and its price is that of the filing day
    as traded. Dates are snapshot days, bounded by the calendar: they are
    broadcast. Tags that are no longer mapped do not count.
    """
    keys = ["ticker", "as_of"]
    spans = vintages.view_intervals(vintages.without_deprecated(facts))
    holds = (F.col("known_from") <= F.col("as_of")) & (F.col("known_to").isNull() | (F.col("as_of") < F.col("known_to")))
    view = written(spans.join(F.broadcast(dates), holds).drop("known_from", "known_to"), "view")
    year = vintages.latest_annual(view, keys)
    wide = share_counts(view, written(wide_rows(view, year.select(*keys, "fiscal_year", "filed"), keys), "wide"), split_table, keys)
    wide = written(wide.drop("splits"), "counted")
    priced = asof.as_of_fresh(wide.select(*keys, "filed"), prices, "ticker", "filed", "date", "close")
    factor = splits.with_factor(priced, split_table, "price_date")
    price = factor.select(*keys, (F.col("close") / F.col("factor")).alias("price"))
    native = written(quarter_features(view, split_table, keys, wide), "native")
    whole = wide.join(price, keys, "left").join(native, keys, "left")
    labels = companies.join(whole.select(*keys), keys if "as_of" in companies.columns else ["ticker"])
    return indicator_rows(whole.join(labels.select(*keys, "sector", "industry"), keys), [*keys, "sector", "industry", "fiscal_year"])


#: Components of ms_score, and whether above the sector's median is good.
ABOVE = {"ms_roa": True, "ms_cfroa": True, "ms_rd": True, "ms_capex": True, "ms_adv": True, "ms_roa_vol": False, "ms_rev_vol": False}
REVENUES = ("revenue_raw", "ing_rev_lag1", "ing_rev_lag2")


def finalize(rows: DataFrame, date: str = "as_of") -> DataFrame:
    """Turn ingredients into cross-section indicators, date by date: capital
    growth less the sector's mean, Mohanram components against the sector's
    median and their sum, industry concentration over three years, and the
    industry's growth in the Whited-Wu index. Unknown groups give null; masks
    apply last, ingredients go.
    """
    sector, industry = [date, "sector"], [date, "industry"]
    out = cross_section.demeaned(rows, "ch_inv_ia", sector)
    out = cross_section.against_median(out, ABOVE, sector)
    parts = [F.col(n) for n in FAMILIES["mohanram"] if n != "ms_score"]
    out = out.withColumn("ms_score", sum(parts[1:], parts[0]))
    known = rows.where(cross_section.known_group("industry"))
    positive = {r: F.when(F.col(r) > 0, F.col(r)) for r in REVENUES}
    sums = known.groupBy(*industry).agg(
        *(F.sum(c * c).alias(f"_q_{r}") for r, c in positive.items()), *(F.sum(c).alias(f"_s_{r}") for r, c in positive.items()),
        *(F.count(c).alias(f"_n_{r}") for r, c in positive.items()),
        F.sum(F.when(F.col("ing_rev_lag1").isNotNull(), F.col("revenue_raw"))).alias("_now"),
        F.sum(F.when(F.col("revenue_raw").isNotNull(), F.col("ing_rev_lag1"))).alias("_before"),
        F.count(F.when(F.col("revenue_raw").isNotNull() & F.col("ing_rev_lag1").isNotNull(), 1)).alias("_both"),
    )
    enough = F.greatest(F.lit(2.0), F.ceil(F.col("_n_revenue_raw") / 2).cast("double"))
    shares = F.array_compact(F.array(*(
        F.when(F.col(f"_n_{r}") >= enough, F.col(f"_q_{r}") / (F.col(f"_s_{r}") * F.col(f"_s_{r}"))) for r in REVENUES
    )))
    mean = F.when(F.size(shares) > 0, F.aggregate(shares, F.lit(0.0), lambda a, x: a + x) / F.size(shares))
    growth_ = F.when((F.col("_both") >= 2) & (F.col("_before") > 0), F.col("_now") / F.col("_before") - 1)
    groups = sums.select(*industry, mean.alias("_herf"), growth_.alias("_g"))
    out = out.join(groups, industry, "left").withColumns(
        {"herf": F.col("_herf"), "ww_index": F.col("ww_index") + F.lit(0.102) * F.col("_g") / 4}
    )
    return cross_section.masked_columns(out.drop("_herf", "_g", "ing_rev_lag1", "ing_rev_lag2"))


def scores(rows: DataFrame, values: list[str], date: str = "as_of") -> DataFrame:
    """(ticker, date, name, value, z): robust scores of finalised rows; a
    masked cell is null and so neither calibrates nor scores."""
    long = cross_section.melt(rows, ["ticker", date], values)
    return cross_section.robust_scores(long, [date, "name"])
