"""Queries of the daily layer's joins, of updates and of validation.

The stand-in layers are plain aggregates of facts that both engines build from
one text; what is compared are the operators that work on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import SECTOR_MASKS, STUBS
from ..functions.kernel import log_safe
from ..operators import cross_section as cs
from ..operators import daily, features, market, periods, splits, validate, vintages
from ..operators.indicators import price_sensitive
from ..streaming import incremental
from .adapter import table
from .cross_queries import MONTH, SECTOR_SCORES, monthly
from .registry import query


def made(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})


_stubs = ", ".join(
    f"max(CASE WHEN (length(concept) + tag_rank + {k}) % 3 > 0 THEN value END) / {1000 if s == 'eps' else 1}e0 AS stub_{s}" for k, s in enumerate(STUBS)
)
_fund = f"""SELECT ticker, fiscal_year, min(filed) AS filed_date, max(period_end) AS period_end, max(value) / 3e4 AS roe,
    max(CASE WHEN concept = 'revenue' THEN value END) / 1e5 AS eps_growth_yoy, min(value) / 5e4 AS f_score, {_stubs} FROM {{facts}} WHERE fiscal_qtr = 'FY' GROUP BY 1, 2"""
_quarters = f"""SELECT ticker, fiscal_year, fiscal_qtr AS quarter, min(filed) AS filed_date, max(period_end) AS period_end, max(value) / 7e4 AS roe,
    max(value) / 3 AS q3m_revenue, {_stubs} FROM {{facts}} WHERE fiscal_qtr <> 'FY' GROUP BY 1, 2, 3"""
_eps = "SELECT ticker, period_end AS qend, filed, max(value) / 1e3 AS eps_ttm FROM {facts} WHERE concept = 'eps_diluted' GROUP BY 1, 2, 3"
_shares = """SELECT ticker, filed, period_end, value FROM {facts} WHERE concept = 'shares_outstanding' AND value > 0 AND form <> '8-K'"""
_after = "coalesce((SELECT product(s.ratio) FROM {{splits}} s WHERE s.ticker = {0} AND s.ex_date > {1}), 1)"
PRICED = ["market_cap", "pe_trailing", "peg", "ev_ebitda", "z_score", "payout_yield"]


def _daily_sql(quarters: bool) -> str:
    latest = "SELECT ticker, period_end, filed_date, 'FY' AS quarter, roe, CAST(NULL AS DOUBLE) AS q3m_revenue, " + ", ".join(f"stub_{s}" for s in STUBS) + " FROM fund"
    if quarters:
        latest += " UNION ALL SELECT ticker, period_end, filed_date, quarter, roe, q3m_revenue, " + ", ".join(f"stub_{s}" for s in STUBS) + " FROM quarters"
    formulas = ", ".join(f"{e} AS {n}" for n, e in price_sensitive("stub_").items() if n in PRICED)
    return f"""WITH fund AS ({_fund}), quarters AS ({_quarters}), eps AS ({_eps}),
    counts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, filed ORDER BY period_end DESC, value DESC) AS rn FROM ({_shares})) WHERE rn = 1),
    days AS (SELECT ticker, date, {_after.format('p.ticker', 'p.date')} AS f, close FROM {{prices}} p),
    latest AS ({latest}),
    a AS (SELECT * FROM (SELECT d.ticker, d.date, d.f, d.close / d.f AS price, fund.fiscal_year, fund.filed_date, fund.eps_growth_yoy, fund.f_score,
      row_number() OVER (PARTITION BY d.ticker, d.date ORDER BY fund.fiscal_year DESC) AS rn FROM days d JOIN fund ON fund.ticker = d.ticker AND fund.filed_date <= d.date) WHERE rn = 1),
    b AS (SELECT * FROM (SELECT a.* EXCLUDE (rn), l.* EXCLUDE (ticker, filed_date), l.filed_date AS filed_date_q,
      row_number() OVER (PARTITION BY a.ticker, a.date ORDER BY l.period_end DESC, l.filed_date DESC, l.quarter DESC) AS rn FROM a JOIN latest l ON l.ticker = a.ticker AND l.filed_date <= a.date) WHERE rn = 1),
    c AS (SELECT * FROM (SELECT b.* EXCLUDE (rn), k.value AS shares, k.filed AS shares_filed,
      row_number() OVER (PARTITION BY b.ticker, b.date ORDER BY k.filed DESC) AS rn FROM b LEFT JOIN counts k ON k.ticker = b.ticker AND k.filed <= b.date) WHERE rn = 1),
    e AS (SELECT *, shares IS NOT NULL AND NOT (shares_filed < filed_date_q AND stub_shares IS NOT NULL) AS fresh FROM c),
    g AS (SELECT * REPLACE (
        CASE WHEN fresh THEN shares ELSE stub_shares END * (f / CASE WHEN fresh THEN {_after.format('e.ticker', 'e.shares_filed')} ELSE {_after.format('e.ticker', 'e.filed_date_q')} END) AS stub_shares,
        stub_eps / (f / {_after.format('e.ticker', 'e.filed_date_q')}) AS stub_eps) FROM e),
    h AS (SELECT * FROM (SELECT g.* EXCLUDE (rn), x.eps_ttm / g.f AS eps_ttm, row_number() OVER (PARTITION BY g.ticker, g.date ORDER BY x.qend DESC, x.eps_ttm DESC) AS rn
      FROM g LEFT JOIN eps x ON x.ticker = g.ticker AND x.filed <= g.date) WHERE rn = 1)
    SELECT ticker, date, price, fiscal_year, filed_date, filed_date_q, roe, f_score,
      {"period_end AS period_end_q, quarter AS quarter_q, q3m_revenue," if quarters else ""}
      {formulas}, eps_ttm, CASE WHEN eps_ttm >= 0.01 THEN price / eps_ttm END AS pe_ttm FROM h"""


def _daily(spark: SparkSession, sf_dir: str, quarters: bool) -> DataFrame:
    facts, cuts = table(spark, sf_dir, "facts"), table(spark, sf_dir, "splits")
    out = daily.daily_layer(
        table(spark, sf_dir, "prices"), spark.sql(_fund, facts=facts), daily.pershare_layer(facts), cuts, ["roe", "f_score"],
        spark.sql(_eps, facts=facts), spark.sql(_quarters, facts=facts) if quarters else None,
    )
    stamps = ["period_end_q", "quarter_q", "q3m_revenue"] if quarters else []
    # no sums: both engines get the same doubles, which rounding might part
    return out.select("ticker", "date", "price", "fiscal_year", "filed_date", "filed_date_q", *stamps, "roe", "f_score", *PRICED, "eps_ttm", "pe_ttm")


@query(_daily_sql(False), dates="date filed_date filed_date_q")
def daily_annual_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily layer of an annual fund layer: years, shares, splits, TTM."""
    return _daily(spark, sf_dir, False)


@query(_daily_sql(True), dates="date filed_date filed_date_q period_end_q")
def daily_both_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily layer with quarterly rows between the annual ones."""
    return _daily(spark, sf_dir, True)


_first = "SELECT * FROM {prices} WHERE ticker % 3 <> 0"
_second = "SELECT ticker, date, close + 1 AS close FROM {prices}"


@query(
    f"""WITH f AS (SELECT * FROM ({_first}) WHERE ticker NOT IN (1, 2)) SELECT ticker, date, close, 1 AS source FROM f
    UNION ALL SELECT ticker, date, close, 2 FROM ({_second}) WHERE ticker NOT IN (SELECT ticker FROM f)""",
    dates="date",
)
def price_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.chosen_prices(made(spark, sf_dir, _first, "prices"), made(spark, sf_dir, _second, "prices"), [1, 2])


@query(
    f"""SELECT ticker, date, close * 0.99e0 * f AS open, close * f AS close, 1000 / f AS volume, close * f AS adjusted
    FROM (SELECT *, {_after.format('p.ticker', 'p.date')} AS f FROM {{prices}} p)""",
    dates="date",
)
def raw_to_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = made(spark, sf_dir, "SELECT ticker, date, close * 0.99e0 AS open, close, 1000e0 AS volume FROM {prices}", "prices")
    out = market.to_split_adjusted(raw, table(spark, sf_dir, "splits"))
    return out.select("ticker", "date", "open", "close", "volume", "adjusted")


_vendor = "SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, max(round(1 + l_tax * 10 * l_linenumber, 3)) AS split_factor FROM {lineitem} GROUP BY 1, 2"


@query(
    f"""SELECT ticker, date AS ex_date, round(1 / x, 9) AS ratio FROM (SELECT *, split_factor AS x FROM ({_vendor})) WHERE x > 0 AND abs(ln(x)) >= ln(1.15)
      AND len(list_filter(range(1, 11), lambda q: round_even(x * q, 0) >= 1 AND round_even(x * q, 0) <> q AND abs(x * q / round_even(x * q, 0) - 1) <= 0.002)) > 0""",
    dates="ex_date",
)
def derived_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.split_events(made(spark, sf_dir, _vendor, "lineitem")).withColumn("ratio", F.round("ratio", 9))


@query(
    """WITH c AS (SELECT * FROM {splits} WHERE ticker % 2 = 0), f AS (SELECT * FROM {splits} WHERE ticker % 3 = 0),
    st AS (SELECT ticker, CASE WHEN ticker % 5 = 0 THEN 'failed' WHEN ticker NOT IN (SELECT ticker FROM f) AND ticker IN (SELECT ticker FROM c) THEN 'kept' ELSE 'fetched' END AS state FROM {companies}),
    r AS (SELECT c.* FROM c JOIN st USING (ticker) WHERE state <> 'fetched' UNION ALL SELECT f.* FROM f JOIN st USING (ticker) WHERE state = 'fetched')
    SELECT st.ticker, state, count(r.ex_date) AS n, max(r.ex_date) AS last_split FROM st LEFT JOIN r USING (ticker) GROUP BY 1, 2""",
    dates="last_split",
)
def split_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, companies = table(spark, sf_dir, "splits"), table(spark, sf_dir, "companies")
    found, states = market.refreshed_splits(known.where("ticker % 2 = 0"), known.where("ticker % 3 = 0"), companies.select("ticker", (F.col("ticker") % 5 != 0).alias("answered")))
    return states.join(found, "ticker", "left").groupBy("ticker", "state").agg(F.count("ex_date").alias("n"), F.max("ex_date").alias("last_split"))


@query(
    """WITH st AS (SELECT ticker, CASE WHEN ticker % 11 <> 0 THEN DATE '1997-06-30' END AS last FROM {companies} WHERE ticker % 13 <> 0),
    act AS (SELECT st.*, CASE WHEN ticker % 7 = 0 THEN 'hold' WHEN ticker IN (SELECT ticker FROM {splits} WHERE ex_date > DATE '1997-06-30') THEN 'rebuild' ELSE 'append' END AS action FROM st)
    SELECT a.ticker, a.action, count(p.date) AS n, min(p.date) AS first_day, max(p.date) AS last_day FROM act a JOIN {prices} p ON p.ticker = a.ticker
    WHERE a.action = 'rebuild' OR (a.action = 'append' AND (a.last IS NULL OR p.date > a.last)) GROUP BY 1, 2""",
    dates="first_day last_day",
)
def incremental_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an update writes: whole tickers with new splits, days after the
    cursor of others, nothing where the check failed."""
    cuts = table(spark, sf_dir, "splits")
    before = splits.fingerprints(cuts.where("ex_date <= DATE '1997-06-30'"))
    state = table(spark, sf_dir, "companies").join(before, "ticker", "left").select(
        "ticker", F.coalesce("splits_hash", F.lit("0")).alias("splits_hash"), F.when(F.col("ticker") % 13 == 0, "removed").otherwise("ok").alias("status"),
        F.when(F.col("ticker") % 11 != 0, F.lit("1997-06-30").cast("date")).alias("last_daily_date"),
    )
    checks = state.select("ticker", F.when(F.col("ticker") % 7 == 0, "failed").otherwise("fetched").alias("state"))
    plan = incremental.plan_updates(state, cuts, checks)
    rows = incremental.fresh_rows(table(spark, sf_dir, "prices"), plan).join(plan.select("ticker", "action"), "ticker")
    return rows.groupBy("ticker", "action").agg(F.count("date").alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


_known = "SELECT ticker, max(concat(CAST(filed AS STRING), ' ', accession)) AS f FROM {facts} WHERE filed < DATE '1998-01-01' GROUP BY 1"


@query(
    """WITH n AS (SELECT ticker, max(concat(CAST(filed AS VARCHAR), ' ', accession)) AS f FROM {facts} WHERE form IN ('10-K', '10-Q') GROUP BY 1),
    k AS (SELECT ticker, max(concat(CAST(filed AS VARCHAR), ' ', accession)) AS f FROM {facts} WHERE filed < DATE '1998-01-01' GROUP BY 1)
    SELECT CAST(n.ticker AS VARCHAR) AS cik, substr(n.f, 12) AS accession, substr(n.f, 1, 10) AS filed FROM n JOIN k USING (ticker) WHERE n.f <> k.f"""
)
def freshness_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "facts").select(F.col("ticker").cast("string").alias("cik"), "ticker", "accession", "filed", "form")
    state = index.where("filed < DATE '1998-01-01'").groupBy("ticker", "cik").agg(F.max_by("accession", F.struct("filed", "accession")).alias("last_filing_accession"))
    out = incremental.stale_entities(state.withColumn("status", F.lit("ok")), index, ["10-K", "10-Q"])
    return out.withColumn("filed", F.col("filed").cast("string"))


_named = "CASE sector WHEN 'AFRICA' THEN 'Financial' WHEN 'AMERICA' THEN 'Utilities' WHEN 'ASIA' THEN 'Real Estate' WHEN 'EUROPE' THEN 'Energy' ELSE 'Technology' END"
_cells = f"""SELECT ticker, date, {_named} AS sector, level AS gpa, size AS o_score, level + size AS herf, CAST(ticker % 11 AS DOUBLE) AS f_score,
    CASE WHEN ticker = 1 THEN level END AS roe FROM {{panel}}"""
_masks = {c: [s for s, names in SECTOR_MASKS.items() if c in names] for c in ("gpa", "o_score", "herf")}
_hidden = ", ".join(f"CASE WHEN sector IN ({', '.join(repr(s) for s in ss)}) THEN NULL ELSE {c} END AS {c}" for c, ss in _masks.items())


@query(f"SELECT ticker, date, sector, {_hidden} FROM ({_cells})", dates="date")
def sector_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cs.masked_columns(made(spark, sf_dir, _cells, "panel")).select("ticker", "date", "sector", *_masks)


def _leak(sector: str) -> str:
    cells = " OR ".join(f"{c} IS NOT NULL" for c, ss in _masks.items() if sector in ss)
    return f"count(*) FILTER (sector = '{sector}' AND ({cells})) = 0"


def _snapshot_checks_sql(rows: str, name: str) -> str:
    named = {
        "ticker_count_plausible": "count(*) BETWEEN 5 AND 600", "all_columns_present": "count(*) < 0", "no_duplicate_tickers": "count(DISTINCT ticker) = count(*)",
        "no_99pct_na_indicators": " AND ".join(f"count({c}) > 0.01 * count(*)" for c in ("gpa", "herf", "roe")), "multiple_sectors": "count(DISTINCT sector) >= 5",
        "no_unknown_sector": "count(*) FILTER (sector IS NULL OR sector = 'Unknown') = 0", "f_score_range_valid": "count(*) FILTER (f_score < 0 OR f_score > 9) = 0",
        **{"mask_fires_" + s.lower().replace(" ", "_"): _leak(s) for s in SECTOR_MASKS},
    }
    return " UNION ALL ".join(f"""SELECT '{name}' AS snapshot, '{n}' AS "check", {e} AS passed FROM {rows}""" for n, e in named.items())


_one_day = "SELECT ticker, sector, max(gpa) AS gpa, max(o_score) AS o_score, max(herf) AS herf, max(f_score) AS f_score, max(roe) AS roe FROM ({0}) WHERE date >= DATE '1998-06-01' AND date < DATE '1998-07-01' GROUP BY 1, 2"


@query(
    f"""WITH raw AS ({_one_day.format(_cells)}), clean AS (SELECT * REPLACE ({_hidden}) FROM raw) {_snapshot_checks_sql('raw', 'raw')} UNION ALL {_snapshot_checks_sql('clean', 'masked')}"""
)
def snapshot_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = made(spark, sf_dir, _one_day.format(_cells), "panel")
    parts = [
        validate.snapshot_checks(rows, ["gpa", "herf", "roe", "ww_index"], (5, 600)).select(F.lit(name).alias("snapshot"), "check", "passed")
        for name, rows in (("raw", raw), ("masked", cs.masked_columns(raw)))
    ]
    return parts[0].unionByName(parts[1])


_leaks = " UNION ALL ".join(
    f"""SELECT 'mask_fires_{s.lower().replace(" ", "_")}' AS "check", count(*) FILTER (sector = '{s}' AND ({" OR ".join(f"{c} IS NOT NULL" for c, ss in _masks.items() if s in ss)})) AS failures FROM d"""
    for s in SECTOR_MASKS
)


@query(
    f"""WITH d AS ({_cells}), near AS (SELECT s.ticker, s.ex_date, p.date, p.level AS v, p.date - s.ex_date AS gap FROM {{splits}} s JOIN {{panel}} p ON p.ticker = s.ticker AND p.date - s.ex_date BETWEEN -14 AND 14),
    a AS (SELECT ticker, ex_date, arg_max(v, date) FILTER (gap < 0) AS before, arg_min(v, date) FILTER (gap >= 0) AS after FROM near GROUP BY 1, 2),
    c AS (SELECT 'tickers_present' AS "check", greatest(0, 100 - count(DISTINCT ticker)) AS failures FROM d
      UNION ALL SELECT 'sector_coverage_complete', count(DISTINCT ticker) FILTER (sector = 'Unknown') FROM d UNION ALL {_leaks}
      UNION ALL SELECT 'split_consistent_market_cap', count(*) FILTER (abs(ln(after / before)) > ln(1.2)) FROM a)
    SELECT "check", CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM c"""
)
def daily_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = made(spark, sf_dir, _cells, "panel")
    rows = layer.join(table(spark, sf_dir, "panel").select("ticker", "date", F.col("level").alias("market_cap")), ["ticker", "date"])
    return validate.daily_checks(rows, layer.select("ticker", "sector").distinct(), table(spark, sf_dir, "splits"))


@query(
    """WITH f AS (SELECT * FROM {facts}), c AS (
      SELECT 'filed_after_period' AS "check", count(*) FILTER (filed < period_end) AS failures FROM f UNION ALL SELECT 'value_present', count(*) FILTER (value IS NULL) FROM f
      UNION ALL SELECT 'companies_have_facts', (SELECT count(*) FROM {supplier} WHERE s_suppkey + 1 NOT IN (SELECT ticker FROM f))
      UNION ALL SELECT 'vintages_unique', (SELECT count(*) FROM (SELECT 1 FROM f GROUP BY ticker, concept, period_end, fiscal_qtr, accession, tag HAVING count(*) > 1))
      UNION ALL SELECT 'core_concepts_covered', (SELECT count(*) FROM (SELECT unnest(['revenue', 'cash', 'goodwill']) AS concept) n WHERE
        coalesce((SELECT count(DISTINCT ticker) FROM f WHERE f.concept = n.concept AND value IS NOT NULL), 0) < 0.8 * (SELECT count(DISTINCT ticker) FROM f)))
    SELECT "check", CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM c"""
)
def build_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1).alias("ticker"))
    return validate.build_checks(table(spark, sf_dir, "facts"), roster, ["revenue", "cash", "goodwill"])


@query(
    f"""WITH m AS ({MONTH}), long AS (SELECT ticker, month, sector, 'level' AS name, level AS value FROM m WHERE month > DATE '1998-01-01'), {SECTOR_SCORES}
    SELECT ticker, month AS date, round(z, 6) + 0e0 AS cs_sec_level FROM z""",
    dates="date",
)
def feature_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an update appends to the stored places within sectors."""
    rows = monthly(spark, sf_dir).withColumnRenamed("month", "date")
    within, middles = features.sector_parts(rows.where("date <= DATE '1998-01-01'"), ["level"], 1)
    fresh, _ = features.advanced_parts(rows, within, middles, ["level"], 1)
    return fresh.withColumn("cs_sec_level", F.round("cs_sec_level", 6))


@query("SELECT ticker, date, round(CASE WHEN level - 1e4 >= 0 THEN 1 ELSE -1 END * ln(1 + abs(level - 1e4)), 6) AS x FROM {panel}", dates="date")
def signed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "panel").select("ticker", "date", F.round(log_safe(F.col("level") - 1e4), 6).alias("x"))


_quarterly_level = "SELECT ticker, CAST(date_trunc('quarter', date) AS DATE) AS qend, avg(CASE WHEN ticker % 5 > 0 THEN level END) AS x FROM {panel} GROUP BY 1, 2"


@query(
    f"""WITH t AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY qend DESC) AS rn FROM ({_quarterly_level}) WHERE x IS NOT NULL)
    SELECT ticker, round(CASE WHEN count(*) >= 8 THEN stddev_samp(x) END, 6) AS deviation FROM t WHERE rn <= 16 GROUP BY 1"""
)
def trailing_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir, _quarterly_level, "panel")
    return periods.trailing_deviation(rows, ["ticker"], "x").withColumn("deviation", F.round("deviation", 6))


@query(
    f"SELECT ticker, qend, round(x, 6) AS x FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY qend DESC) AS rn FROM ({_quarterly_level})) WHERE rn <= 4",
    dates="qend",
)
def last_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cs.last_rows(made(spark, sf_dir, _quarterly_level, "panel"), ["ticker"], "qend", 4)
    return rows.withColumn("x", F.round("x", 6))


_unlabelled = "SELECT accession, concept, period_start, period_end, CASE WHEN tag_rank = 0 THEN fiscal_qtr END AS fiscal_qtr, tag FROM {facts}"


@query(
    f"""SELECT concept, tag, fiscal_qtr, period_start, period_end, count(*) AS n, CASE WHEN fiscal_qtr IN ('Q1', 'Q2', 'Q3', 'Q4', 'FY') THEN fiscal_qtr
      WHEN period_end - period_start > 300 THEN 'FY' WHEN period_end - period_start BETWEEN 60 AND 120 THEN 'Q' || quarter(period_end) END AS period_type
    FROM ({_unlabelled}) GROUP BY ALL""",
    dates="period_start period_end",
)
def period_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = made(spark, sf_dir, _unlabelled, "facts").withColumn("period_type", vintages.period_type())
    return rows.groupBy("concept", "tag", "fiscal_qtr", "period_start", "period_end", "period_type").agg(F.count("*").alias("n"))


@query("SELECT ticker, count(*) AS n FROM {facts} WHERE NOT (concept = 'revenue' AND tag IN ('revenue_1', 'revenue_2')) GROUP BY 1")
def mapped_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vintages.without_deprecated(table(spark, sf_dir, "facts"), {"revenue": ["revenue_1", "revenue_2"]}).groupBy("ticker").agg(F.count("*").alias("n"))


_sheet = ["revenue", "cash", "inventory", "capex", "sga", "depreciation", "ppe_net"]


@query(
    f"""WITH w AS (SELECT ticker, fiscal_year, {', '.join(f"max(value) FILTER (concept = '{c}') AS {c}" for c in _sheet)} FROM {{facts}} WHERE fiscal_qtr = 'FY' GROUP BY 1, 2)
    SELECT ticker, fiscal_year FROM w WHERE {' + '.join(f'CASE WHEN {c} IS NULL THEN 0 ELSE 1 END' for c in _sheet)} >= 3"""
)
def dense_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "facts").where("fiscal_qtr = 'FY'").groupBy("ticker", "fiscal_year").pivot("concept", _sheet).agg(F.max("value"))
    return rows.where(vintages.dense(_sheet, 3)).select("ticker", "fiscal_year")
