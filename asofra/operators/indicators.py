"""The indicator catalogue, as SQL expressions over one wide row.

A wide row has the current fiscal year's concepts under ``c_``, earlier years'
under ``p_`` (one year back) and ``l2_`` to ``l5_``, quarterly results under
``q_``, share counts with their split ratios, and price and market_cap. All
rules follow one shape: guarded division, nulls pass through, and zero stands
for a missing value only where it is written.
"""

from __future__ import annotations

from ..constants import CONCEPT_TAGS, INDICATORS, SECTOR_MASKS
from ..functions.kernel import any_known, available, div, flag, given, grow, known, z0

CONCEPTS = list(CONCEPT_TAGS)


def derived(x: str = "") -> list[dict[str, str]]:
    """Quantities of one fiscal year, in layers: each uses those before."""
    c = lambda name: x + name
    at, act, lct, cash = c("total_assets"), c("current_assets"), c("current_liabilities"), c("cash")
    ltd, std, ceq, ni = c("long_term_debt"), c("short_term_debt"), c("stockholders_equity"), c("net_income")
    dv = f"abs({z0(c('dividends_paid'))})"
    ebit = f"{ni} + {z0(c('interest_expense'))} + {c('income_tax_expense')}"
    lever = div(c("total_debt"), f"{c('total_debt')} + {ceq}")
    first = {
        "gross_profit": f"{c('revenue')} - {c('cogs')}",
        "ebitda": f"{c('operating_income')} + {c('depreciation')}",
        "fcf": f"{c('operating_cashflow')} - {c('capex')}",
        "total_debt": available(ltd, std),
        "che": f"{cash} + {z0(c('st_investments'))}",
        "liab": f"coalesce({c('total_liabilities')}, {at} - {ceq} - {z0(c('minority_interest'))})",
        "fna": f"{z0(c('st_investments'))} + {z0(c('lt_investments'))}",
        "finl": available(ltd, std, c("preferred_stock")),
        "cf_num": f"{ni} + {z0(c('depreciation'))}",
        "coa": f"{act} - {cash}",
        "col": f"{lct} - {z0(std)}",
        "ncoa": f"{at} - {act} - {z0(c('lt_investments'))}",
    }
    second = {
        "net_debt": f"{c('total_debt')} - {cash}",
        "ncol": f"{c('liab')} - {lct} - {z0(ltd)}",
        "fin": f"{c('fna')} - {c('finl')}",
        "noa": f"({at} - {cash}) - ({c('liab')} - {c('total_debt')})",
        "wc": f"{c('coa')} - {c('col')}",
        "ncash": f"{c('che')} - {c('total_debt')}",
        "ndp_num": f"{c('finl')} - {c('che')}",
        "z_prefix": given(f"{at} > 0", f"(1.2e0 * ({act} - {lct}) + 1.4e0 * {c('retained_earnings')} + 3.3e0 * ({ebit}) + {c('revenue')}) / {at}"),
        "kz_prefix": given(
            f"abs({c('ppe_net')}) >= 1 AND {at} > 0",
            f"-1.002e0 * {c('cf_num')} / {c('ppe_net')} + 0.283e0 * ({at} - {ceq}) / {at} + 3.139e0 * {lever}"
            f" - 39.368e0 * {dv} / {c('ppe_net')} - 1.315e0 * {c('che')} / {c('ppe_net')}",
        ),
    }
    third = {"nco": f"{c('ncoa')} - {c('ncol')}", "ltnoa": f"{c('noa')} - {c('wc')}"}
    return [{c(k): v for k, v in layer.items()} for layer in (first, second, third)]


def ab98(x0: str, x1: str, x2: str) -> str:
    """Growth on the mean of two earlier years, else on the last."""
    base = f"(({x1} + {x2}) / 2)"
    return f"coalesce({div(f'{x0} - {base}', base)}, {div(f'{x0} - {x1}', x1)})"


def statutory_rate(end: str, start: str) -> str:
    """0.35 for years ended by 2017, 0.21 for those begun later, by days in
    between. A start that makes no fiscal year is replaced by 364 days before.
    Days are given as day numbers."""
    cut = "17531"
    good = given(f"{end} - {start} + 1 BETWEEN 150 AND 400", start)
    begin = f"coalesce({good}, {end} - 364)"
    old = f"({cut} - {begin} + 1)"
    days = f"({end} - {begin} + 1)"
    return (
        f"(CASE WHEN {end} <= {cut} THEN 0.35e0 WHEN {begin} > {cut} THEN 0.21e0"
        f" ELSE (0.35e0 * {old} + 0.21e0 * ({days} - {old})) / {days} END)"
    )


def formulas() -> dict[str, str]:
    """Indicator to expression, in catalogue order; hidden ingredients after.
    Cross-section indicators are here as the company's own ingredient."""
    c, p = (lambda n: f"c_{n}"), (lambda n: f"p_{n}")
    rev, cogs, ni, at, ceq, cfo = c("revenue"), c("cogs"), c("net_income"), c("total_assets"), c("stockholders_equity"), c("operating_cashflow")
    act, lct, inv, rnd, sga, capx = c("current_assets"), c("current_liabilities"), c("inventory"), c("rnd"), c("sga"), c("capex")
    dep, tax, che, at_p, me = c("depreciation"), c("income_tax_expense"), c("che"), p("total_assets"), "market_cap"
    avg = f"(({at} + {at_p}) / 2)"
    d = lambda n: f"(c_{n} - p_{n})"
    dv, bb, iss = f"abs({c('dividends_paid')})", f"abs({c('buybacks')})", c("equity_issuance")
    ev = f"({me} + {c('net_debt')})"
    change = lambda n: z0(f"c_{n} - p_{n}")
    ta = f"({d('wc')} + {d('nco')} + {d('fin')})"
    debt_net = given(any_known(c("debt_issuance"), c("debt_repayment"), c("short_term_debt"), p("short_term_debt")),
                     f"{z0(c('debt_issuance'))} - {z0(c('debt_repayment'))} + {z0(c('short_term_debt'))} - {z0(p('short_term_debt'))}")
    equity_net = given(any_known(iss, bb, dv), f"{z0(iss)} - {z0(bb)} - {z0(dv)}")
    ratio = {k: div(f"{k}_revenue", f"({k}_noa + {prev}_noa) / 2") for k, prev in (("c", "p"), ("p", "l2"))}
    positive = lambda x: given(f"{x} >= 0", x)
    ci = [div(f"{k}_capex", f"{k}_revenue") for k in ("c", "p", "l2")]
    ci_n = " + ".join(f"CASE WHEN {x} IS NOT NULL THEN 1 ELSE 0 END" for x in ci)
    stock = " + ".join(f"{w}e0 * {z0(f'{k}_rnd')}" for w, k in zip((1, 0.8, 0.6, 0.4, 0.2), ("c", "p", "l2", "l3", "l4")))
    chin = div(f"{ni} - p_net_income", f"abs({ni}) + abs(p_net_income)")
    out = {
        "pe_trailing": div("price", c("eps_diluted"), "0.01"),
        "peg": given(f"{grow(c('eps_diluted'), p('eps_diluted'))} > 0", div(div("price", c("eps_diluted"), "0.01"), f"100 * {grow(c('eps_diluted'), p('eps_diluted'))}")),
        "pb": div(me, ceq), "ps": div(me, rev), "pfcf": div(me, c("fcf")),
        "ev_ebitda": div(ev, c("ebitda")), "ev_revenue": div(ev, rev),
        "earnings_yield": div(c("eps_diluted"), "price", "0.01"),
        "gross_margin": div(c("gross_profit"), rev), "operating_margin": div(c("operating_income"), rev),
        "net_margin": div(ni, rev), "roe": div(ni, ceq), "roa": div(ni, at),
        "roic": div(ni, f"{ceq} + {c('total_debt')} - {c('cash')}"),
        "revenue_growth_yoy": grow(rev, p("revenue")), "revenue_growth_qoq": "q_revenue_growth_qoq",
        "eps_growth_yoy": grow(c("eps_diluted"), p("eps_diluted")),
        "opinc_growth_yoy": grow(c("operating_income"), p("operating_income")), "ebitda_growth": grow(c("ebitda"), p("ebitda")),
        "debt_equity": div(c("total_debt"), ceq), "net_debt_ebitda": div(c("net_debt"), c("ebitda")),
        "interest_coverage": div(c("operating_income"), c("interest_expense"), "1"),
        "current_ratio": div(act, lct), "quick_ratio": div(f"{act} - {z0(inv)}", lct),
        "asset_turnover": div(rev, at), "inventory_turnover": div(cogs, inv), "receivables_turnover": div(rev, c("accounts_receivable")),
        "fcf_ni": div(c("fcf"), ni, "1"), "opcf_ni": div(cfo, ni, "1"), "capex_revenue": div(capx, rev),
        "dividend_yield": div(dv, me), "payout_ratio": div(dv, ni), "buyback_yield": div(bb, me),
        "market_cap": me, "enterprise_value": ev, "revenue_raw": rev, "shares_outstanding": c("shares_outstanding"), "public_float": c("public_float"),
        "gpa": div(c("gross_profit"), at), "asset_growth": grow(at, at_p), "sloan_accrual": div(f"{ni} - {cfo}", avg),
        "pct_accruals": div(f"{ni} - {cfo}", f"abs({ni})", "1"),
        "net_operating_assets": div(f"({at} - {c('cash')}) - ({c('total_liabilities')} - {c('total_debt')})", at_p),
        "f_roa": flag(f"{div(ni, at)} > 0"), "f_droa": flag(f"{div(ni, at)} > {div(p('net_income'), at_p)}"),
        "f_cfo": flag(f"{div(cfo, at)} > 0"), "f_accrual": flag(f"{cfo} > {ni}"),
        "f_dlever": flag(f"{div(c('long_term_debt'), at)} < {div(p('long_term_debt'), at_p)}"),
        "f_dliquid": flag(f"{div(act, lct)} > {div(p('current_assets'), p('current_liabilities'))}"),
        "f_eq_off": flag(f"{c('shares_outstanding')} <= {p('shares_outstanding')}"),
        "f_dmargin": flag(f"{div(c('gross_profit'), rev)} > {div(p('gross_profit'), p('revenue'))}"),
        "f_dturn": flag(f"{div(rev, at)} > {div(p('revenue'), at_p)}"),
    }
    out["f_score"] = " + ".join(out[f] for f in ("f_roa", "f_droa", "f_cfo", "f_accrual", "f_dlever", "f_dliquid", "f_eq_off", "f_dmargin", "f_dturn"))
    capdep = div(capx, dep)
    out |= {
        "cash_based_op": div(
            f"{rev} - {cogs} - {sga} + {z0(rnd)} - {change('accounts_receivable')} - {change('inventory')} - {change('prepaid_expenses')}"
            f" + {change('deferred_revenue')} + {change('accounts_payable')} + {change('accrued_liabilities')}", at),
        "fcf_stability": "q_fcf_stability",
        "sga_efficiency": f"{grow(sga, p('sga'))} - {grow(rev, p('revenue'))}",
        "capex_depreciation": f"(CASE WHEN {capdep} > 5 THEN 5e0 ELSE {capdep} END)",
        "dso_change": f"365 * ({div(c('accounts_receivable'), rev)} - {div(p('accounts_receivable'), p('revenue'))})",
        "inventory_sales_change": f"{div(inv, cogs)} - {div(p('inventory'), p('cogs'))}",
        "del_coa": div(d("coa"), avg), "del_col": div(d("col"), avg), "del_finl": div(d("finl"), avg),
        "del_lti": div(f"{z0(c('lt_investments'))} - {z0(p('lt_investments'))}", avg),
        "del_equ": div(d("stockholders_equity"), avg), "del_netfin": div(d("fin"), avg), "total_accruals": div(ta, avg),
        "dnoa": div(d("noa"), at_p), "ch_nncoa": div(d("nco"), at_p), "ch_nwc": div(d("wc"), at_p),
        "inventory_change": div(d("inventory"), avg), "inventory_growth": grow(inv, p("inventory")),
        "ppe_inv_change": div(f"({c('ppe_gross')} + {z0(inv)}) - ({p('ppe_gross')} + {z0(p('inventory'))})", at_p),
        "equity_growth": given(f"{ceq} > 0 AND {p('stockholders_equity')} > 0", grow(ceq, p("stockholders_equity"))),
        "gr_ltnoa": div(d("ltnoa"), avg),
        "net_debt_finance": div(debt_net, avg), "net_equity_finance": div(equity_net, avg),
        "xfin": f"{div(debt_net, avg)} + {div(equity_net, avg)}",
        "composite_debt_issuance": given("c_total_debt > 0 AND l5_total_debt > 0", "ln(c_total_debt / l5_total_debt)"),
        "share_iss_1y": grow("shares_0 * ratio_1", "shares_1"), "share_iss_5y": grow("shares_0 * ratio_5", "shares_5"),
        "net_payout_yield": div(given(any_known(dv, bb, iss), f"{z0(dv)} + {z0(bb)} - {z0(iss)}"), me),
        "ch_tax": "q_ch_tax", "num_earn_increase": "q_num_earn_increase", "revenue_surprise": "q_revenue_surprise",
        "earnings_surprise": "q_earnings_surprise", "earnings_consistency": "q_earnings_consistency", "roaq": "q_roaq",
        "rd_me": div(rnd, me), "ebm": div(f"{ceq} + {c('ncash')}", f"{me} + {c('ncash')}"),
        "bpebm": f"{div(ceq, me)} - {div(f'{ceq} + c_ncash', f'{me} + c_ncash')}",
        "cf_me": div(c("cf_num"), me), "cfp": div(cfo, me), "net_debt_price": div(c("ndp_num"), me),
        "tang": div(f"{che} + 0.715e0 * {z0(c('accounts_receivable'))} + 0.547e0 * {z0(inv)} + 0.535e0 * {c('ppe_gross')}", at),
        "tax_to_book": given(known(tax, ni, "tax_rate"), f"CASE WHEN {tax} > 0 AND {ni} <= 0 THEN 1e0 ELSE {div(f'{tax} / tax_rate', ni, '1')} END"),
        "effective_tax_rate": div(tax, c("pretax_income")), "am": div(at, me),
        "book_leverage": given(f"{ceq} > 0", div(at, ceq)), "leverage_mkt": div(c("liab"), me), "cash_prod": div(f"{me} - {at}", che, "1"),
        "oper_prof": given(f"{ceq} > 0", div(f"{rev} - {cogs} - {sga} - {c('interest_expense')}", ceq)),
        "cash_assets": div(che, at), "op_leverage": div(f"{cogs} + {z0(sga)}", at),
        "payout_yield": div(given(any_known(dv, bb), f"{z0(dv)} + {z0(bb)}"), me), "salecash": div(rev, che, "1"),
        "depr_rate": div(dep, c("ppe_net")),
        "pchdepr": grow(div(dep, c("ppe_net")), div(p("depreciation"), p("ppe_net"))),
        "grcapx": given("l2_capex > 0", f"({capx} - l2_capex) / l2_capex"),
        "grcapx3y": given("p_capex + l2_capex + l3_capex > 0", f"3 * {capx} / (p_capex + l2_capex + l3_capex)"),
        "pct_tot_acc": div(ta, f"abs({ni})", "1"),
        "ch_asset_turnover": f"{positive(ratio['c'])} - {positive(ratio['p'])}",
        "gr_sale_to_gr_inv": given("p_period_end IS NOT NULL", f"{ab98(rev, 'p_revenue', 'l2_revenue')} - {ab98(inv, 'p_inventory', 'l2_inventory')}"),
        "surprise_rd": given(
            f"p_rnd > 0 AND {rev} IS NOT NULL AND {rev} <> 0 AND {at} > 0 AND {at_p} > 0",
            flag(f"{rnd} / {rev} > 0 AND {rnd} / {at} > 0 AND {rnd} / p_rnd > 1.05e0 AND ({rnd} / {at}) / (p_rnd / {at_p}) > 1.05e0")),
        "investment": given(f"{rev} >= 1e7 AND {ci[0]} IS NOT NULL AND {ci_n} >= 2", div(ci[0], f"({' + '.join(z0(x) for x in ci)}) / ({ci_n})")),
        "rd_cap": given(known("p_period_end", "l2_period_end", "l3_period_end", "l4_period_end"), div(stock, at)),
        "ch_inv_ia": ab98(capx, "p_capex", "l2_capex"),
        "ms_roa": div(ni, avg), "ms_cfroa": div(cfo, avg), "ms_accrual": flag(f"{cfo} > {ni}"),
        "ms_roa_vol": "q_ms_roa_vol", "ms_rev_vol": "q_ms_rev_vol",
        "ms_rd": given(f"{at} IS NOT NULL", div(z0(rnd), at_p)), "ms_capex": given(f"{at} IS NOT NULL", div(capx, at_p)),
        "ms_adv": given(f"{at} IS NOT NULL", div(z0(c("advertising")), at_p)),
        "ms_score": "CAST(NULL AS DOUBLE)",
        "o_score": given(
            f"{at} > 0",
            f"-1.32e0 - 0.407e0 * ln({at} / 1e6) + 6.03e0 * c_liab / {at} - 1.43e0 * ({act} - {lct}) / {at} + 0.076e0 * {div(lct, act)}"
            f" - 1.72e0 * {flag(f'c_liab > {at}')} - 2.37e0 * {ni} / {at} - 1.83e0 * {div(cfo, 'c_liab')} + 0.285e0 * {flag(f'{ni} + p_net_income < 0')} - 0.521e0 * {chin}"),
        "z_score": f"c_z_prefix + 0.6e0 * {div(me, 'c_liab')}",
        "herf": rev,
        "kz_index": f"c_kz_prefix + 0.283e0 * {div(me, at)}",
        "ww_index": given(
            f"{at} > 0",
            f"-0.091e0 * c_cf_num / (4 * {at}) - 0.062e0 * (CASE WHEN {dv} > 0 THEN 1 ELSE 0 END) + 0.021e0 * {z0(c('long_term_debt'))} / {at}"
            f" - 0.044e0 * ln({at} / 1e6) - 0.035e0 * {grow(rev, p('revenue'))} / 4"),
    }
    return {name: out[name] for name in INDICATORS}


def masked(name: str, expression: str, sector: str = "sector") -> str:
    """Null in the sectors where the indicator has no meaning."""
    sectors = [s for s, names in SECTOR_MASKS.items() if name in names]
    if not sectors:
        return expression
    listed = ", ".join(f"'{s}'" for s in sectors)
    return f"(CASE WHEN {sector} IN ({listed}) THEN NULL ELSE {expression} END)"


def price_sensitive(x: str = "stub_") -> dict[str, str]:
    """The daily form of the price indicators, from the last filing's stubs.
    Unlike the formulas above it wants positive equity, cash flow and EBITDA,
    and falls back to total debt where net debt is missing."""
    s = lambda name: x + name
    me = f"(price * {s('shares')})"
    ev = f"({me} + coalesce({s('net_debt')}, {s('total_debt')}))"
    pe = div("price", s("eps"), "0.01")
    dv, bb, iss = f"abs({s('dividends')})", f"abs({s('buybacks')})", s("equity_issuance")
    ebm = div(f"{s('equity')} + {s('net_cash')}", f"{me} + {s('net_cash')}")
    return {
        "market_cap": me, "enterprise_value": ev, "pe_trailing": pe,
        "peg": given("eps_growth_yoy > 0", div(pe, "eps_growth_yoy * 100")),
        "pb": given(f"{s('equity')} > 0", div(me, s("equity"))), "ps": div(me, s("revenue")),
        "pfcf": given(f"{s('fcf')} > 0", div(me, s("fcf"))), "ev_ebitda": given(f"{s('ebitda')} > 0", div(ev, s("ebitda"))),
        "ev_revenue": div(ev, s("revenue")), "earnings_yield": div(s("eps"), "price", "0.01"),
        "dividend_yield": div(dv, me), "buyback_yield": div(bb, me),
        "net_payout_yield": div(given(any_known(dv, bb, iss), f"{z0(dv)} + {z0(bb)} - {z0(iss)}"), me),
        "rd_me": div(s("rnd"), me), "ebm": ebm, "bpebm": f"{div(s('equity'), me)} - {ebm}", "cf_me": div(s("cf_num"), me),
        "cfp": div(s("cfo"), me), "net_debt_price": div(s("ndp_num"), me), "am": div(s("assets"), me),
        "leverage_mkt": div(s("liabilities"), me), "cash_prod": div(f"{me} - {s('assets')}", s("che"), "1"),
        "payout_yield": div(given(any_known(dv, bb), f"{z0(dv)} + {z0(bb)}"), me),
        "z_score": f"{s('z_prefix')} + 0.6e0 * {div(me, s('liabilities'))}",
        "kz_index": f"{s('kz_prefix')} + 0.283e0 * {div(me, s('assets'))}",
    }


#: Stub to the current year's column it carries.
STUB_SOURCES = {
    "shares": "shares_outstanding", "eps": "eps_diluted", "equity": "stockholders_equity", "revenue": "revenue", "fcf": "fcf",
    "ebitda": "ebitda", "total_debt": "total_debt", "net_debt": "net_debt", "cash": "cash", "dividends": "dividends_paid",
    "buybacks": "buybacks", "equity_issuance": "equity_issuance", "rnd": "rnd", "assets": "total_assets", "liabilities": "liab",
    "cf_num": "cf_num", "cfo": "operating_cashflow", "che": "che", "net_cash": "ncash", "ndp_num": "ndp_num",
    "z_prefix": "z_prefix", "kz_prefix": "kz_prefix",
}
