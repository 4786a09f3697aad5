"""Quarterly rows: TTM indicators as known on each quarter's filing day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import STUBS, TTM_QUARTERLY
from ..functions.kernel import div, given, growth, guarded, z0
from ..functions.storage import written
from . import quarter_kernel, snapshot, splits, vintages
from .indicators import CONCEPTS, STUB_SOURCES, masked

FLOWS = (
    "revenue cogs sga net_income operating_cashflow capex operating_income depreciation dividends_paid buybacks"
    " income_tax_expense pretax_income interest_expense rnd"
).split()
#: Native quarter indicators and the column of ``quarter_features`` they are.
NATIVE = "roaq revenue_surprise earnings_surprise revenue_growth_qoq ch_tax num_earn_increase fcf_stability ms_roa_vol ms_rev_vol".split()
NO_QUARTER_STUB = ("equity_issuance", "rnd", "cf_num", "z_prefix", "kz_prefix")
TTM_STUBS = {"revenue": "ttm_revenue", "fcf": "ttm_operating_cashflow - ttm_capex", "ebitda": "ttm_operating_income + ttm_depreciation",
             "dividends": "ttm_dividends_paid", "buybacks": "ttm_buybacks", "cfo": "ttm_operating_cashflow"}


def ttm_formulas() -> dict[str, str]:
    """Ratios of four quarters' flows and the quarter's balance sheet."""
    t = {c: f"ttm_{c}" for c in FLOWS}
    gp, ebitda = f"({t['revenue']} - {t['cogs']})", f"({t['operating_income']} + {t['depreciation']})"
    ni, cfo, at, ceq = t["net_income"], t["operating_cashflow"], "total_assets", "stockholders_equity"
    out = {
        "gross_margin": div(gp, t["revenue"]), "operating_margin": div(t["operating_income"], t["revenue"]), "net_margin": div(ni, t["revenue"]),
        "roe": div(ni, ceq), "roa": div(ni, at), "roic": div(ni, f"{ceq} + total_debt - cash"),
        "asset_turnover": div(t["revenue"], at), "inventory_turnover": div(t["cogs"], "inventory"), "receivables_turnover": div(t["revenue"], "accounts_receivable"),
        "fcf_ni": div(f"{cfo} - {t['capex']}", ni, "1"), "opcf_ni": div(cfo, ni, "1"), "capex_revenue": div(t["capex"], t["revenue"]),
        "payout_ratio": div(f"abs({t['dividends_paid']})", ni), "debt_equity": div("total_debt", ceq), "net_debt_ebitda": div("net_debt", ebitda),
        "interest_coverage": div(t["operating_income"], t["interest_expense"], "1"), "current_ratio": div("current_assets", "current_liabilities"),
        "quick_ratio": div(f"current_assets - {z0('inventory')}", "current_liabilities"), "gpa": div(gp, at),
        "pct_accruals": div(f"{ni} - {cfo}", f"abs({ni})", "1"), "effective_tax_rate": div(t["income_tax_expense"], t["pretax_income"]),
        "oper_prof": given(f"{ceq} > 0", div(f"{t['revenue']} - {t['cogs']} - {t['sga']} - {t['interest_expense']}", ceq)),
        "book_leverage": given(f"{ceq} > 0", div(at, ceq)), "cash_assets": div("che", at), "salecash": div(t["revenue"], "che", "1"),
        "depr_rate": div(t["depreciation"], "ppe_net"),
    }
    return {n: out[n] for n in TTM_QUARTERLY}


def quarter_filings(facts: DataFrame) -> DataFrame:
    """(ticker, fiscal_year, quarter, as_of): the first plain quarterly filing
    of each quarter, or the first of any form."""
    rows = facts.where(F.col("fiscal_qtr").isin("Q1", "Q2", "Q3") & F.col("filed").isNotNull() & F.col("fiscal_year").isNotNull())
    agg = rows.groupBy("ticker", "fiscal_year", F.col("fiscal_qtr").alias("quarter")).agg(
        F.min(F.when(F.col("form") == "10-Q", F.col("filed"))).alias("_plain"), F.min("filed").alias("_any")
    )
    return agg.select("ticker", "fiscal_year", "quarter", F.coalesce("_plain", "_any").alias("as_of"))


def quarter_layer(facts: DataFrame, split_table: DataFrame, companies: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """One row per ticker, fiscal year and quarter with the native quarter
    indicators, the TTM indicators, the stubs and the quarter's own flows.

    Every quarter's filing day (or the as_of that ``targets`` names for a
    ticker, fiscal_year and quarter) is a point of view; ``quarter_kernel`` takes
    all series of a bucket of tickers from the vintages' intervals at once.
    """
    keys = ["ticker", "as_of"]
    targets = quarter_filings(facts) if targets is None else targets
    spans = written(vintages.view_intervals(vintages.without_deprecated(facts)), "quarter-spans")
    holds = (F.col("known_from") <= F.col("as_of")) & (F.col("known_to").isNull() | (F.col("as_of") < F.col("known_to")))
    # a quarter's sheet reads that quarter's facts only, so they meet their own day and no other
    labels = targets.select(*keys, "fiscal_year", F.col("quarter").alias("fiscal_qtr")).distinct()
    view = written(spans.join(labels, ["ticker", "fiscal_year", "fiscal_qtr"]).where(holds), "quarter-view")
    sheet = written(vintages.pivot(view, CONCEPTS, keys).where(vintages.dense(CONCEPTS)), "quarter-sheet").withColumnRenamed("period_type", "quarter")
    flows = view.where(F.col("fiscal_qtr").isin("Q1", "Q2", "Q3"))
    ends = flows.groupBy(*keys, "fiscal_year", F.col("fiscal_qtr").alias("quarter")).agg(
        F.max(F.when(F.col("period_start").isNotNull(), F.col("period_end"))).alias("_flow"), F.max("period_end").alias("_any")
    )
    ends = ends.select(*keys, "fiscal_year", "quarter", F.coalesce("_flow", "_any").alias("period_end"))
    own = written(targets.join(sheet, [*keys, "fiscal_year", "quarter"]).join(ends, [*keys, "fiscal_year", "quarter"]), "quarter-rows")
    out = written(quarter_kernel.with_series(own, spans, split_table, FLOWS), "quarter-series")
    # the deviations of a year's quarters need a fiscal year's end, which a quarter's row has not
    out = out.withColumns({
        "q_roaq": guarded(F.col("net"), F.col("net_at")), "q_revenue_surprise": F.col("revenue_surprise"), "q_earnings_surprise": F.col("eps_surprise"),
        "q_revenue_growth_qoq": growth(F.col("rev"), F.col("rev_before")), "q_ch_tax": guarded(F.col("tax") - F.col("tax_before"), F.col("tax_at")),
        "q_num_earn_increase": F.col("streak"), "q_fcf_stability": F.col("fcf_stability"),
        "q_ms_roa_vol": F.lit(None).cast("double"), "q_ms_rev_vol": F.lit(None).cast("double"),
    }).drop(*quarter_kernel.FEATURES)
    # derived quantities last, over a plain table: the optimiser would carry
    # every constraint of the joins through each layer of expressions
    out = snapshot.with_derived(written(splits.with_factor(out.join(companies, "ticker"), split_table, "as_of"), "quarter-whole"))
    made = {n: F.expr(masked(n, f"({e})")) for n, e in ttm_formulas().items()}
    stubs = {}
    for stub in STUBS:
        text = "_eps / factor" if stub == "eps" else "CAST(NULL AS DOUBLE)" if stub in NO_QUARTER_STUB else TTM_STUBS.get(stub, STUB_SOURCES[stub])
        stubs[f"stub_{stub}"] = F.expr(masked("net_debt_price", text) if stub == "ndp_num" else text)
    return out.select(
        "ticker", "sector", "industry", "fiscal_year", "quarter", F.col("as_of").alias("filed_date"), "period_end",
        *(F.col(f"q_{n}").alias(n) for n in NATIVE), *(c.alias(n) for n, c in (made | stubs).items()), *(f"q3m_{c}" for c in FLOWS),
    )
