"""Fixed values of the domain, stated in their natural order."""

# Concepts and their tags, the preferred tag first.
CONCEPT_TAGS = {
    "revenue": (
        "Revenues",
        "RevenueFromContractWithCustomerExcludingAssessedTax",
        "SalesRevenueNet",
        "SalesRevenueGoodsNet",
        "SalesRevenueServicesNet",
        "RevenueFromContractWithCustomerIncludingAssessedTax",
    ),
    "cogs": (
        "CostOfGoodsAndServicesSold",
        "CostOfRevenue",
        "CostOfGoodsSold",
        "CostOfGoodsAndServiceExcludingDepreciationDepletionAndAmortization",
    ),
    "operating_income": (
        "OperatingIncomeLoss",
    ),
    "net_income": (
        "NetIncomeLoss",
    ),
    "eps_basic": (
        "MulticlassEPSBasic",
        "EarningsPerShareBasic",
    ),
    "eps_diluted": (
        "MulticlassEPSDiluted",
        "EarningsPerShareDiluted",
        "EarningsPerShareBasicAndDiluted",
    ),
    "interest_expense": (
        "InterestExpense",
        "InterestExpenseDebt",
    ),
    "sga": (
        "SellingGeneralAndAdministrativeExpense",
    ),
    "rnd": (
        "ResearchAndDevelopmentExpense",
        "ResearchAndDevelopmentExpenseExcludingAcquiredInProcessCost",
    ),
    "depreciation": (
        "DepreciationDepletionAndAmortization",
        "DepreciationAndAmortization",
        "Depreciation",
    ),
    "income_tax_expense": (
        "IncomeTaxExpenseBenefit",
    ),
    "pretax_income": (
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesMinorityInterestAndIncomeLossFromEquityMethodInvestments",
    ),
    "advertising": (
        "AdvertisingExpense",
        "MarketingAndAdvertisingExpense",
    ),
    "total_assets": (
        "Assets",
    ),
    "stockholders_equity": (
        "StockholdersEquity",
        "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
    ),
    "long_term_debt": (
        "LongTermDebt",
        "LongTermDebtNoncurrent",
        "LongTermDebtAndCapitalLeaseObligations",
    ),
    "short_term_debt": (
        "ShortTermBorrowings",
        "ShortTermDebtCurrent",
        "DebtCurrent",
        "ShortTermBankLoansAndNotesPayable",
    ),
    "current_assets": (
        "AssetsCurrent",
    ),
    "current_liabilities": (
        "LiabilitiesCurrent",
    ),
    "total_liabilities": (
        "Liabilities",
    ),
    "accounts_receivable": (
        "AccountsReceivableNetCurrent",
        "AccountsReceivableNet",
    ),
    "inventory": (
        "InventoryNet",
        "InventoryFinishedGoodsNetOfReserves",
    ),
    "cash": (
        "CashAndCashEquivalentsAtCarryingValue",
        "CashCashEquivalentsAndShortTermInvestments",
        "Cash",
    ),
    "shares_outstanding": (
        "MulticlassSharesOutstanding",
        "MulticlassSharesOutstandingBS",
        "CommonStockSharesOutstanding",
        "EntityCommonStockSharesOutstanding",
        "WeightedAverageNumberOfShareOutstandingBasicAndDiluted",
        "WeightedAverageNumberOfDilutedSharesOutstanding",
    ),
    "public_float": (
        "EntityPublicFloat",
    ),
    "accounts_payable": (
        "AccountsPayableCurrent",
        "AccountsPayableAndAccruedLiabilitiesCurrent",
    ),
    "accrued_liabilities": (
        "AccruedLiabilitiesCurrent",
    ),
    "deferred_revenue": (
        "DeferredRevenueCurrent",
        "ContractWithCustomerLiabilityCurrent",
        "DeferredRevenueCurrentAndNoncurrent",
    ),
    "prepaid_expenses": (
        "PrepaidExpenseAndOtherAssetsCurrent",
        "PrepaidExpenseAndOtherAssets",
        "PrepaidExpenseCurrent",
    ),
    "ppe_net": (
        "PropertyPlantAndEquipmentNet",
        "PropertyPlantAndEquipmentAndFinanceLeaseRightOfUseAssetAfterAccumulatedDepreciationAndAmortization",
    ),
    "ppe_gross": (
        "PropertyPlantAndEquipmentGross",
        "PropertyPlantAndEquipmentAndFinanceLeaseRightOfUseAssetBeforeAccumulatedDepreciationAndAmortization",
    ),
    "st_investments": (
        "ShortTermInvestments",
        "MarketableSecuritiesCurrent",
        "AvailableForSaleSecuritiesCurrent",
    ),
    "lt_investments": (
        "LongTermInvestments",
        "MarketableSecuritiesNoncurrent",
        "AvailableForSaleSecuritiesNoncurrent",
        "EquityMethodInvestments",
    ),
    "retained_earnings": (
        "RetainedEarningsAccumulatedDeficit",
    ),
    "preferred_stock": (
        "PreferredStockValue",
        "PreferredStockValueOutstanding",
    ),
    "goodwill": (
        "Goodwill",
    ),
    "intangibles": (
        "IntangibleAssetsNetExcludingGoodwill",
        "FiniteLivedIntangibleAssetsNet",
    ),
    "minority_interest": (
        "MinorityInterest",
    ),
    "operating_cashflow": (
        "NetCashProvidedByUsedInOperatingActivities",
        "NetCashProvidedByOperatingActivities",
        "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations",
    ),
    "capex": (
        "PaymentsToAcquirePropertyPlantAndEquipment",
        "PaymentsToAcquireProductiveAssets",
    ),
    "buybacks": (
        "PaymentsForRepurchaseOfCommonStock",
        "PaymentsForRepurchaseOfEquity",
    ),
    "dividends_paid": (
        "PaymentsOfDividendsCommonStock",
        "PaymentsOfDividends",
        "Dividends",
    ),
    "debt_issuance": (
        "ProceedsFromIssuanceOfLongTermDebt",
        "ProceedsFromIssuanceOfSeniorLongTermDebt",
        "ProceedsFromIssuanceOfLongTermDebtAndCapitalSecuritiesNet",
        "ProceedsFromIssuanceOfDebt",
        "ProceedsFromDebtNetOfIssuanceCosts",
        "ProceedsFromDebtMaturingInMoreThanThreeMonths",
    ),
    "debt_repayment": (
        "RepaymentsOfLongTermDebt",
        "RepaymentsOfSeniorDebt",
        "RepaymentsOfLongTermDebtAndCapitalSecurities",
        "RepaymentsOfDebtAndCapitalLeaseObligations",
        "RepaymentsOfDebt",
        "RepaymentsOfDebtMaturingInMoreThanThreeMonths",
    ),
    "equity_issuance": (
        "ProceedsFromIssuanceOfCommonStock",
        "ProceedsFromIssuanceOrSaleOfEquity",
        "ProceedsFromIssuanceOfSharesUnderIncentiveAndShareBasedCompensationPlansIncludingStockOptions",
        "ProceedsFromStockOptionsExercised",
    ),
}

# Indicator families and their indicators, in the order of the catalogue.
FAMILIES = {
    "valuation": ["pe_trailing", "peg", "pb", "ps", "pfcf", "ev_ebitda", "ev_revenue", "earnings_yield"],
    "profitability": ["gross_margin", "operating_margin", "net_margin", "roe", "roa", "roic"],
    "growth": [
        "revenue_growth_yoy", "revenue_growth_qoq", "eps_growth_yoy", "opinc_growth_yoy", "ebitda_growth",
    ],
    "leverage": ["debt_equity", "net_debt_ebitda", "interest_coverage", "current_ratio", "quick_ratio"],
    "efficiency": ["asset_turnover", "inventory_turnover", "receivables_turnover"],
    "cashflow_quality": ["fcf_ni", "opcf_ni", "capex_revenue"],
    "shareholder": ["dividend_yield", "payout_ratio", "buyback_yield"],
    "size": ["market_cap", "enterprise_value", "revenue_raw", "shares_outstanding", "public_float"],
    "piotroski": [
        "f_roa", "f_droa", "f_cfo", "f_accrual", "f_dlever", "f_dliquid", "f_eq_off", "f_dmargin", "f_dturn",
        "f_score",
    ],
    "research": [
        "gpa", "asset_growth", "sloan_accrual", "pct_accruals", "net_operating_assets", "cash_based_op",
        "fcf_stability", "sga_efficiency", "capex_depreciation", "dso_change", "inventory_sales_change",
    ],
    "balance_sheet_change": [
        "del_coa", "del_col", "del_finl", "del_lti", "del_equ", "del_netfin", "total_accruals", "dnoa",
        "ch_nncoa", "ch_nwc", "inventory_change", "inventory_growth", "ppe_inv_change", "equity_growth",
        "gr_ltnoa",
    ],
    "financing": [
        "net_debt_finance", "net_equity_finance", "xfin", "composite_debt_issuance", "share_iss_1y",
        "share_iss_5y", "net_payout_yield",
    ],
    "surprise": [
        "ch_tax", "num_earn_increase", "revenue_surprise", "earnings_surprise", "earnings_consistency", "roaq",
    ],
    "levels": [
        "rd_me", "ebm", "bpebm", "cf_me", "cfp", "net_debt_price", "tang", "tax_to_book", "effective_tax_rate",
        "am", "book_leverage", "leverage_mkt", "cash_prod", "oper_prof", "cash_assets", "op_leverage",
        "payout_yield", "salecash", "depr_rate",
    ],
    "investment": [
        "pchdepr", "grcapx", "grcapx3y", "pct_tot_acc", "ch_asset_turnover", "gr_sale_to_gr_inv", "surprise_rd",
        "investment", "rd_cap", "ch_inv_ia",
    ],
    "mohanram": [
        "ms_roa", "ms_cfroa", "ms_accrual", "ms_roa_vol", "ms_rev_vol", "ms_rd", "ms_capex", "ms_adv",
        "ms_score",
    ],
    "distress": ["o_score", "z_score"],
    "structure": ["herf", "kz_index", "ww_index"],
}

INDICATORS = [name for names in FAMILIES.values() for name in names]

# Lower is preferred; any other form comes last.
FORM_PRIORITY = {
    "10-K": 1, "10-K/A": 1, "20-F": 1, "20-F/A": 1, "40-F": 1, "40-F/A": 1,
    "10-Q": 2, "10-Q/A": 2,
}
LAST_RANK = 99
ANNUAL_FORMS = [form for form, rank in FORM_PRIORITY.items() if rank == 1]

# Expected length of a period in days, by its label.
EXPECTED_DAYS = {"Q1": (60, 120), "Q2": (160, 200), "Q3": (250, 290), "Q4": (330, 380), "FY": (330, 380)}
# Length classes of a period in days.
DURATIONS = {"3mo": (60, 120), "2Q": (160, 200), "3Q": (250, 290), "FY": (330, 380)}

SECTORS = [
    "Basic Materials", "Communication Services", "Consumer Cyclical", "Consumer Defensive", "Energy", "Financial",
    "Healthcare", "Industrials", "Real Estate", "Technology", "Utilities",
]
UNKNOWN_SECTOR = "Unknown"

# Indicators without meaning in a sector.
SECTOR_MASKS = {
    "Financial": [
        "gpa", "inventory_turnover", "cash_based_op", "capex_depreciation", "inventory_sales_change",
        "inventory_change", "inventory_growth", "ppe_inv_change", "tang", "op_leverage", "ch_asset_turnover",
        "gr_sale_to_gr_inv", "net_debt_price", "o_score", "z_score",
    ],
    "Utilities": ["o_score", "z_score", "herf"],
    "Real Estate": ["o_score", "z_score"],
}

PRICE_SENSITIVE = [
    "pe_trailing", "peg", "pb", "ps", "pfcf", "ev_ebitda", "ev_revenue", "earnings_yield", "dividend_yield",
    "buyback_yield", "market_cap", "enterprise_value", "net_payout_yield", "rd_me", "ebm", "bpebm", "cf_me",
    "cfp", "net_debt_price", "am", "leverage_mkt", "cash_prod", "payout_yield", "z_score", "kz_index",
]
STUBS = [
    "shares", "eps", "equity", "revenue", "fcf", "ebitda", "total_debt", "net_debt", "cash", "dividends",
    "buybacks", "equity_issuance", "rnd", "assets", "liabilities", "cf_num", "cfo", "che", "net_cash",
    "ndp_num", "z_prefix", "kz_prefix",
]
# 0/1 components: features carry them as they are.
PASSTHROUGH = [
    "f_roa", "f_droa", "f_cfo", "f_accrual", "f_dlever", "f_dliquid", "f_eq_off", "f_dmargin", "f_dturn",
    "ms_roa", "ms_cfroa", "ms_accrual", "ms_roa_vol", "ms_rev_vol", "ms_rd", "ms_capex", "ms_adv",
]
STANDARDIZED = [name for name in INDICATORS if name not in PASSTHROUGH]
LOG_TRANSFORMED = ["market_cap", "enterprise_value", "revenue_raw", "shares_outstanding", "public_float"]

NATIVE_QUARTERLY = [
    "roaq", "revenue_surprise", "earnings_surprise", "revenue_growth_qoq", "ch_tax", "num_earn_increase",
    "fcf_stability", "ms_roa_vol", "ms_rev_vol", "ing_ms_roa_vol", "ing_ms_rev_vol",
]
TTM_QUARTERLY = [
    "gross_margin", "operating_margin", "net_margin", "roe", "roa", "roic", "asset_turnover",
    "inventory_turnover", "receivables_turnover", "fcf_ni", "opcf_ni", "capex_revenue", "payout_ratio",
    "debt_equity", "net_debt_ebitda", "interest_coverage", "current_ratio", "quick_ratio", "gpa",
    "pct_accruals", "effective_tax_rate", "oper_prof", "book_leverage", "cash_assets", "salecash", "depr_rate",
]
SHARES_TAGS = ["MulticlassSharesOutstanding", "EntityCommonStockSharesOutstanding", "MulticlassSharesOutstandingBS"]
PERSHARE_FORMS = list(FORM_PRIORITY)
DEPRECATED_TAGS = {"interest_expense": ["InterestIncomeExpenseNet"]}


def indicator_names(families: list[str] | None = None) -> list[str]:
    """The indicators of the named families (any case), in catalogue order."""
    if families is None:
        return list(INDICATORS)
    wanted = {f.lower() for f in families}
    if unknown := wanted - set(FAMILIES):
        raise ValueError(f"unknown family: {', '.join(sorted(unknown))}; valid: {', '.join(FAMILIES)}")
    chosen = {name for f in wanted for name in FAMILIES[f]}
    return [name for name in INDICATORS if name in chosen]
