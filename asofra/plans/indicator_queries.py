"""Queries of the indicator families and of the quarter operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DURATIONS, FAMILIES, indicator_names
from ..functions.storage import written
from ..operators import asof, indicators, periods, quarterly, snapshot, splits, vintages
from .adapter import table
from .asof_queries import AS_OF, RANKED, view_sql
from .registry import query

#: Indicators that need more than annual rows; they have queries of their own.
QUARTERLY_ONLY = {n for n, e in indicators.formulas().items() if e.startswith("q_")} | {"ms_score"}
DATE = f"DATE '{AS_OF}'"


def _layers() -> str:
    ctes, source = [], "fyp"
    for k, layer in enumerate(indicators.derived()):
        ctes.append(f"d{k} AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in layer.items())} FROM {source})")
        source = f"d{k}"
    return ", ".join(ctes)


def _wide_sql() -> str:
    fields = [*indicators.CONCEPTS, *(n for layer in indicators.derived() for n in layer)]
    prefixes = {"c_": 0, "p_": 1, "l2_": 2, "l3_": 3, "l4_": 4, "l5_": 5}
    columns = ", ".join(f"r{k}.{f} AS {x}{f}" for x, k in prefixes.items() for f in (*fields, "period_end", "filed"))
    joins = " ".join(
        f"LEFT JOIN d2 r{k} ON r{k}.ticker = t.ticker AND r{k}.period_end = make_date(t.fiscal_year - {k}, 12, 31)"
        f" AND r{k}.total_assets IS NOT NULL AND r0.total_assets IS NOT NULL" for k in range(1, 6)
    )
    pivoted = ", ".join(f"max(value) FILTER (concept = '{c}') AS {c}" for c in indicators.CONCEPTS)
    shares = "max({}) FILTER (concept = 'shares_outstanding')"
    ratio = "(SELECT coalesce(product(s.ratio), 1) FROM {{splits}} s WHERE s.ticker = w.ticker AND s.ex_date > w.{} AND s.ex_date <= w.r0_filed)"
    start = "(c_period_end - 364 - DATE '1970-01-01')"
    rate = indicators.statutory_rate("(c_period_end - DATE '1970-01-01')", start)
    return f"""WITH {RANKED}, view AS (SELECT * FROM {view_sql(f"filed <= {DATE}")}),
    fyp AS (SELECT ticker, period_end, max(filed) AS filed, {pivoted}, {shares.format('value')} AS shares_at, {shares.format('filed')} AS shares_filed
      FROM view WHERE fiscal_qtr = 'FY' AND value IS NOT NULL GROUP BY 1, 2), {_layers()},
    target AS (SELECT ticker, max(fiscal_year) AS fiscal_year FROM (SELECT ticker, fiscal_year FROM view WHERE fiscal_qtr = 'FY' AND value IS NOT NULL
      GROUP BY 1, 2 HAVING count(DISTINCT concept) >= 5) GROUP BY 1),
    w AS (SELECT t.ticker, t.fiscal_year, {columns}, CASE WHEN r0.total_assets IS NOT NULL THEN r0.shares_at END AS shares_0,
        CASE WHEN r0.total_assets IS NOT NULL THEN r0.shares_filed END AS r0_filed,
        r1.shares_at AS shares_1, r1.shares_filed AS r1_filed, r5.shares_at AS shares_5, r5.shares_filed AS r5_filed
      FROM target t JOIN d2 r0 ON r0.ticker = t.ticker AND r0.period_end = make_date(t.fiscal_year, 12, 31) {joins}),
    asked AS (SELECT w.ticker, w.c_filed, CASE WHEN w.c_filed - p.date <= 10 THEN p.close /
        (SELECT coalesce(product(s.ratio), 1) FROM {{splits}} s WHERE s.ticker = w.ticker AND s.ex_date > p.date) END AS price
      FROM w ASOF LEFT JOIN {{prices}} p ON w.ticker = p.ticker AND w.c_filed >= p.date),
    whole AS (SELECT w.*, a.price, a.price * c_shares_outstanding AS market_cap, {rate} AS tax_rate, {ratio.format('r1_filed')} AS ratio_1,
        {ratio.format('r5_filed')} AS ratio_5 FROM w JOIN asked a ON a.ticker = w.ticker)"""


WIDE_SQL = _wide_sql()


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, cuts = table(spark, sf_dir, "facts"), table(spark, sf_dir, "splits")
    view = written(vintages.as_of_view(facts, F.lit(AS_OF).cast("date")), "view")
    year = vintages.latest_annual(view)
    rows = snapshot.share_counts(view, snapshot.wide_rows(view, year.select("ticker", "fiscal_year"), ["ticker"]), cuts, ["ticker"])
    priced = asof.as_of_fresh(rows.select("ticker", "c_filed"), table(spark, sf_dir, "prices"), "ticker", "c_filed", "date", "close")
    factor = splits.with_factor(priced, cuts, "price_date")
    price = factor.select("ticker", (F.col("close") / F.col("factor")).alias("price"))
    out = rows.drop("splits").join(price, "ticker", "left").withColumn("market_cap", F.col("price") * F.col("c_shares_outstanding"))
    return out.withColumn("tax_rate", snapshot.tax_rate())


def _family(name: str) -> None:
    made = {n: e for n, e in indicators.formulas().items() if n in FAMILIES[name] and n not in QUARTERLY_ONLY}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return wide(spark, sf_dir).select("ticker", "fiscal_year", *(F.round(F.expr(e), 6).alias(n) for n, e in made.items()))

    run.__name__ = f"indicators_{name}"
    query(f"{WIDE_SQL} SELECT ticker, fiscal_year, {', '.join(f'round({e}, 6) + 0e0 AS {n}' for n, e in made.items())} FROM whole")(run)


for _name in FAMILIES:
    if set(FAMILIES[_name]) - QUARTERLY_ONLY:
        _family(_name)


@query(
    f"""{WIDE_SQL}, stub AS (SELECT ticker, {', '.join(f'c_{c} AS stub_{s}' for s, c in indicators.STUB_SOURCES.items())}, {indicators.formulas()['eps_growth_yoy']} AS eps_growth_yoy FROM whole),
    d AS (SELECT s.*, p.date, p.close AS price FROM stub s JOIN {{prices}} p ON p.ticker = s.ticker WHERE p.date >= {DATE})
    SELECT ticker, date, {', '.join(f'round({e}, 6) + 0e0 AS {n}' for n, e in indicators.price_sensitive().items())} FROM d""",
    dates="date",
)
def price_sensitive_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wide(spark, sf_dir)
    stubs = rows.select(
        "ticker", *(F.col(f"c_{c}").alias(f"stub_{s}") for s, c in indicators.STUB_SOURCES.items()), F.expr(indicators.formulas()["eps_growth_yoy"]).alias("eps_growth_yoy")
    )
    days = table(spark, sf_dir, "prices").where(f"date >= {DATE}").withColumnRenamed("close", "price")
    daily = stubs.join(days, "ticker")
    return daily.select("ticker", "date", *(F.round(F.expr(e), 6).alias(n) for n, e in indicators.price_sensitive().items()))


_kind = "CASE " + " ".join(f"WHEN period_end - period_start BETWEEN {a} AND {b} THEN '{k}'" for k, (a, b) in DURATIONS.items()) + " END"


def flow_sql(concept: str) -> str:
    def pair(high: str, low: str) -> str:
        return f"""SELECT a.ticker, a.period_end AS qend, greatest(a.filed, b.filed) AS filed, a.value - b.value AS value, 1 AS derived
          FROM r a JOIN r b ON a.ticker = b.ticker AND a.period_start = b.period_start AND a.kind = '{high}' AND b.kind = '{low}'
          WHERE a.period_end - b.period_end BETWEEN 60 AND 131"""

    return f"""WITH k AS (SELECT *, {_kind} AS kind FROM {{facts}} WHERE concept = '{concept}' AND period_start IS NOT NULL AND value IS NOT NULL),
    r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, period_start, kind ORDER BY CASE WHEN form = '8-K' THEN 1 ELSE 0 END,
      filed, period_end, value) AS rn FROM k WHERE kind IS NOT NULL) WHERE rn = 1),
    parts AS (SELECT ticker, period_end AS qend, filed, value, 0 AS derived FROM r WHERE kind = '3mo'
      UNION ALL {pair('2Q', '3mo')} UNION ALL {pair('3Q', '2Q')} UNION ALL {pair('FY', '3Q')}),
    q AS (SELECT ticker, qend, filed, value FROM (SELECT *, row_number() OVER (PARTITION BY ticker, qend ORDER BY derived, filed, value) AS rn
      FROM parts) WHERE rn = 1)"""


@query(f"{flow_sql('revenue')} SELECT ticker, qend, filed, round(value, 4) AS value FROM q", dates="qend filed")
def quarter_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periods.flow_quarters(table(spark, sf_dir, "facts"), "revenue", ["ticker"])
    return out.select("ticker", "qend", "filed", F.round("value", 4).alias("value"))


_instants = """SELECT ticker, period_end AS qend, value FROM (SELECT *, row_number() OVER (PARTITION BY ticker, period_end
  ORDER BY CASE WHEN form = '8-K' THEN 1 ELSE 0 END, filed, value) AS rn FROM {facts} WHERE concept = 'total_assets') WHERE rn = 1"""


@query(f"SELECT ticker, qend, round(value, 4) AS value FROM ({_instants})", dates="qend")
def instant_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periods.instants(table(spark, sf_dir, "facts"), "total_assets", ["ticker"])
    return out.select("ticker", "qend", F.round("value", 4).alias("value"))


def near_sql(days: str, tolerance: int, series: str = "q", value: str = "value") -> str:
    """A scalar subquery: the value of the series nearest to so many days
    before the outer row x."""
    return f"""(SELECT arg_min(y.{value}, (abs(y.qend - (x.qend - {days})), y.qend)) FROM {series} y
      WHERE y.ticker = x.ticker AND abs(y.qend - (x.qend - {days})) <= {tolerance})"""


_lags = [f"x.l{m}" for m in range(1, 9)]
_shift = [round(m * periods.LAG_DAYS) for m in range(1, 9)]
SURPRISE_SQL = f"""WITH q AS ({_instants}), dif AS (SELECT x.ticker, x.qend, x.value, x.value - {near_sql('365', 35)} AS dif FROM q x),
    lag8 AS (SELECT x.ticker, x.qend, x.dif, {', '.join(f"{near_sql(str(s), 40, 'dif', 'dif')} AS l{m}" for m, s in enumerate(_shift, 1))} FROM dif x),
    su AS (SELECT x.ticker, x.qend, x.dif - list_avg([{', '.join(_lags)}]) AS su FROM lag8 x),
    su8 AS (SELECT x.ticker, x.qend, x.su, list_stddev_samp(list_filter([{', '.join(near_sql(str(s), 40, 'su', 'su') for s in _shift)}], lambda v: v IS NOT NULL)) AS sd,
      len(list_filter([{', '.join(near_sql(str(s), 40, 'su', 'su') for s in _shift)}], lambda v: v IS NOT NULL)) AS n FROM su x),
    last AS (SELECT ticker, max(qend) AS qend, count(*) AS quarters FROM q GROUP BY 1)"""


@query(
    f"""{SURPRISE_SQL} SELECT l.ticker, round(CASE WHEN l.quarters >= 4 AND s.n >= 2 AND s.sd > 1e-10 THEN s.su / s.sd END, 6) AS surprise
    FROM last l JOIN su8 s ON s.ticker = l.ticker AND s.qend = l.qend"""
)
def seasonal_surprise(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = periods.instants(table(spark, sf_dir, "facts"), "total_assets", ["ticker"])
    return periods.seasonal_surprise(series, ["ticker"], 1e-10).withColumn("surprise", F.round("surprise", 6))


@query(
    f"""{SURPRISE_SQL}, s AS (SELECT x.ticker, [x.dif, {', '.join(_lags)}] AS ch FROM lag8 x JOIN last l ON l.ticker = x.ticker AND l.qend = x.qend)
    SELECT ticker, CAST(coalesce(list_min(list_filter(range(0, 9), lambda i: ch[i + 1] <= 0)), 0) AS DOUBLE) AS streak FROM s"""
)
def earn_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = periods.instants(table(spark, sf_dir, "facts"), "total_assets", ["ticker"])
    return periods.increase_streak(series, ["ticker"])


@query(
    f"""{flow_sql('revenue')}, a AS (SELECT DISTINCT ticker, qend FROM q),
    t AS (SELECT x.ticker, x.qend, {near_sql('0', 10)} AS v0, {near_sql('91', 40)} AS v1, {near_sql('183', 40)} AS v2, {near_sql('274', 40)} AS v3 FROM a x)
    SELECT ticker, qend AS anchor, round(v0 + v1 + v2 + v3, 4) AS ttm, round(v0, 4) AS q3m FROM t""",
    dates="anchor",
)
def ttm_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarters = periods.flow_quarters(table(spark, sf_dir, "facts"), "revenue", ["ticker"])
    out = periods.ttm(quarters, quarters.select("ticker", F.col("qend").alias("anchor")).distinct(), ["ticker"])
    return out.select("ticker", "anchor", F.round("ttm", 4).alias("ttm"), F.round("q3m", 4).alias("q3m"))


_eps_kind = "CASE WHEN period_end - period_start <= 135 THEN 'Q1' WHEN period_end - period_start <= 225 THEN 'Q2' WHEN period_end - period_start <= 315 THEN 'Q3' ELSE 'FY' END"


@query(
    f"""WITH k AS (SELECT *, {_eps_kind} AS kind FROM {{facts}} WHERE concept = 'eps_diluted' AND period_start IS NOT NULL AND value IS NOT NULL),
    r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, period_start, kind ORDER BY CASE WHEN form = '8-K' THEN 1 ELSE 0 END,
      filed, period_end, value) AS rn FROM k) WHERE rn = 1),
    side AS (SELECT ticker, period_start, {', '.join(f"max({c}) FILTER (kind = '{k}') AS {k}_{c}" for k in ('Q1', 'Q2', 'Q3', 'FY') for c in ('value', 'filed', 'period_end'))} FROM r GROUP BY 1, 2),
    lagged AS (SELECT *, {', '.join(f"lag({k}_value) OVER (PARTITION BY ticker ORDER BY period_start) AS p{k}" for k in ('Q1', 'Q2', 'Q3', 'FY'))} FROM side),
    parts AS (SELECT ticker, FY_period_end AS qend, FY_filed AS filed, FY_value AS eps_ttm FROM lagged
      {' '.join(f"UNION ALL SELECT ticker, {k}_period_end, {k}_filed, {k}_value + pFY - p{k} FROM lagged" for k in ('Q1', 'Q2', 'Q3'))})
    SELECT ticker, qend, filed, round(eps_ttm, 4) AS eps_ttm FROM (SELECT *, row_number() OVER (PARTITION BY ticker, qend ORDER BY filed, eps_ttm) AS rn
      FROM parts WHERE eps_ttm IS NOT NULL) WHERE rn = 1""",
    dates="qend filed",
)
def ttm_eps(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periods.ttm_eps(table(spark, sf_dir, "facts").where("concept = 'eps_diluted'"), ["ticker"])
    return out.select("ticker", "qend", "filed", F.round("eps_ttm", 4).alias("eps_ttm"))


_cfo = """SELECT ticker, fiscal_year, fiscal_qtr AS period_type, arg_max(value, (filed, accession, value)) AS operating_cashflow,
  arg_max(period_end - period_start, (filed, accession, value)) AS period_days FROM {facts}
  WHERE concept = 'operating_cashflow' AND fiscal_qtr <> 'FY' GROUP BY 1, 2, 3"""


@query(
    f"""WITH w AS ({_cfo}), u AS (SELECT *, CASE WHEN {_kind.replace('period_end - period_start', 'period_days')} =
      CASE period_type WHEN 'Q1' THEN '3mo' WHEN 'Q2' THEN '2Q' WHEN 'Q3' THEN '3Q' ELSE 'FY' END THEN operating_cashflow END AS usable FROM w)
    SELECT a.ticker, a.fiscal_year, a.period_type, round(CASE WHEN a.period_type = 'Q1' THEN a.usable ELSE a.usable - b.usable END, 4) AS standalone
    FROM u a LEFT JOIN u b ON a.ticker = b.ticker AND a.fiscal_year = b.fiscal_year AND CAST(right(a.period_type, 1) AS INT) = CAST(right(b.period_type, 1) AS INT) + 1"""
)
def decumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "facts").where("concept = 'operating_cashflow' AND fiscal_qtr <> 'FY'")
    pick = F.struct("filed", "accession", "value")
    wide_ = rows.groupBy("ticker", "fiscal_year", F.col("fiscal_qtr").alias("period_type")).agg(
        F.max_by("value", pick).alias("operating_cashflow"), F.max_by(F.datediff("period_end", "period_start"), pick).alias("period_days")
    )
    out = periods.decumulate(wide_, ["ticker"])
    return out.select("ticker", "fiscal_year", "period_type", F.round("standalone", 4).alias("standalone"))


@query(None)
def quarterly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly TTM indicators, each as known when the quarter's last fact
    was filed."""
    facts, companies = table(spark, sf_dir, "facts"), table(spark, sf_dir, "companies")
    rows = facts.where("fiscal_qtr IN ('Q1', 'Q2', 'Q3')")
    days = rows.groupBy("ticker", "fiscal_year", F.col("fiscal_qtr").alias("quarter")).agg(F.max("filed").alias("as_of"))
    return quarterly.quarter_layer(facts, table(spark, sf_dir, "splits"), companies, days)


@query(None)
def snapshot_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 130 indicators for all companies on several dates in one job."""
    dates = spark.sql("SELECT explode(array(DATE '1997-06-30', DATE '1998-06-30', DATE '1999-06-30')) AS as_of")
    tables = (table(spark, sf_dir, n) for n in ("facts", "prices", "splits", "companies"))
    return snapshot.finalize(snapshot.assemble(*tables, dates))


@query(None)
def snapshot_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Robust scores of the finalised snapshots, in long form."""
    return snapshot.scores(snapshot_indicators(spark, sf_dir), indicators_scored())


def indicators_scored() -> list[str]:
    return indicator_names()


