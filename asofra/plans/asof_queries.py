"""Queries of the vintage, as-of, interval, dimension and split operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ANNUAL_FORMS, EXPECTED_DAYS, FORM_PRIORITY, LAST_RANK
from ..operators import asof, splits, vintages
from .adapter import ANNUAL, table
from .registry import query

AS_OF = "1998-06-30"

_duration = " ".join(
    f"WHEN fiscal_qtr = '{q}' AND NOT (period_end - period_start BETWEEN {a} AND {b}) THEN 1" for q, (a, b) in EXPECTED_DAYS.items()
)
_form = " ".join(f"WHEN form = '{f}' THEN {r}" for f, r in FORM_PRIORITY.items())
RANKED = f"""ranked AS (
  SELECT *, CASE {_duration} ELSE 0 END AS duration_rank, CASE {_form} ELSE {LAST_RANK} END AS form_rank FROM {{facts}})"""
VIEW_ORDER = "duration_rank, form_rank, accession DESC, tag_rank, tag DESC, value DESC"


def view_sql(where: str, keys: str = "ticker", source: str = "ranked") -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, concept, period_end, fiscal_qtr
      ORDER BY {VIEW_ORDER}) AS rn FROM {source} WHERE {where}) WHERE rn = 1)"""


@query(
    """SELECT ticker, concept, round(sum(value), 2) AS total, count(*) AS n FROM {facts}
    WHERE filed >= DATE '1997-01-01' AND filed < DATE '1998-01-01' AND concept IN ('revenue', 'cash') GROUP BY 1, 2"""
)
def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "facts")
    rows = facts.where("filed >= DATE '1997-01-01' AND filed < DATE '1998-01-01'").where(F.col("concept").isin("revenue", "cash"))
    return rows.groupBy("ticker", "concept").agg(F.round(F.sum("value"), 2).alias("total"), F.count("*").alias("n"))


@query(
    f"""WITH {RANKED} SELECT ticker, concept, period_end, fiscal_qtr, accession, form, tag, round(value, 6) AS value
    FROM (SELECT *, row_number() OVER (PARTITION BY ticker, concept, period_end, fiscal_qtr, accession
      ORDER BY duration_rank, form_rank, tag_rank, tag DESC, value DESC) AS rn FROM ranked) WHERE rn = 1""",
    dates="period_end",
)
def vintage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vintages.dedup_filings(table(spark, sf_dir, "facts"))
    return out.select("ticker", "concept", "period_end", "fiscal_qtr", "accession", "form", "tag", F.round("value", 6).alias("value"))


@query(
    f"""WITH {RANKED} SELECT ticker, concept, period_end, fiscal_qtr, accession, round(value, 6) AS value
    FROM {view_sql(f"filed <= DATE '{AS_OF}'")}""",
    dates="period_end",
)
def asof_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vintages.as_of_view(table(spark, sf_dir, "facts"), F.lit(AS_OF).cast("date"))
    return out.select("ticker", "concept", "period_end", "fiscal_qtr", "accession", F.round("value", 6).alias("value"))


@query(
    f"""WITH {RANKED}, days AS (SELECT unnest([DATE '1996-12-31', DATE '1998-06-30', DATE '2000-03-31']) AS day),
    known AS (SELECT * FROM ranked JOIN days ON filed <= day)
    SELECT day, ticker, concept, period_end, fiscal_qtr, accession, round(value, 6) AS value
    FROM {view_sql("TRUE", "day, ticker", "known")}""",
    dates="day period_end",
)
def asof_views_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.sql("SELECT explode(array(DATE '1996-12-31', DATE '1998-06-30', DATE '2000-03-31')) AS day")
    spans = vintages.view_intervals(table(spark, sf_dir, "facts"))
    holds = (F.col("known_from") <= F.col("day")) & (F.col("known_to").isNull() | (F.col("day") < F.col("known_to")))
    out = spans.join(F.broadcast(days), holds)
    return out.select("day", "ticker", "concept", "period_end", "fiscal_qtr", "accession", F.round("value", 6).alias("value"))


@query(
    f"""WITH {RANKED}, years AS (
      SELECT ticker, fiscal_year, count(DISTINCT concept) AS n_concepts, max(filed) AS filed FROM {view_sql(f"filed <= DATE '{AS_OF}'")}
      WHERE fiscal_qtr = 'FY' AND value IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT concept) >= 5)
    SELECT ticker, fiscal_year, n_concepts, filed FROM (
      SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rn FROM years) WHERE rn = 1""",
    dates="filed",
)
def latest_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vintages.latest_annual(vintages.as_of_view(table(spark, sf_dir, "facts"), F.lit(AS_OF).cast("date")))


@query(
    f"""SELECT ticker, fiscal_year, min(filed) AS filed FROM {{facts}} WHERE fiscal_qtr = 'FY'
    AND form IN ({", ".join(f"'{f}'" for f in ANNUAL_FORMS)}) GROUP BY 1, 2""",
    dates="filed",
)
def original_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vintages.original_filing(table(spark, sf_dir, "facts"))


@query(
    f"""WITH {RANKED}, view AS (SELECT * FROM {view_sql(f"filed <= DATE '{AS_OF}'")}),
    newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, fiscal_year, fiscal_qtr, concept
      ORDER BY period_end DESC, filed DESC, accession DESC, value DESC) AS rn2 FROM view) WHERE rn2 = 1)
    SELECT ticker, fiscal_year, fiscal_qtr AS period_type, {", ".join(f"round(max(value) FILTER (concept = '{c}'), 6) AS {c}" for c in ANNUAL)}
    FROM newest GROUP BY 1, 2, 3"""
)
def pivot_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = vintages.as_of_view(table(spark, sf_dir, "facts"), F.lit(AS_OF).cast("date"))
    wide = vintages.pivot(view, ANNUAL)
    return wide.select("ticker", "fiscal_year", "period_type", *(F.round(c, 6).alias(c) for c in ANNUAL))


@query(
    """WITH days AS (SELECT DISTINCT ticker, date AS day FROM {prices}),
    fund AS (SELECT ticker, period_end, filed, max(accession) AS accession FROM {facts} WHERE fiscal_qtr = 'FY' GROUP BY 1, 2, 3)
    SELECT ticker, day, period_end, filed, accession FROM (
      SELECT d.ticker, d.day, f.period_end, f.filed, f.accession,
        row_number() OVER (PARTITION BY d.ticker, d.day ORDER BY f.period_end DESC NULLS LAST, f.filed DESC, f.accession DESC) AS rn
      FROM days d LEFT JOIN fund f ON f.ticker = d.ticker AND f.filed <= d.day) WHERE rn = 1""",
    dates="day period_end filed",
)
def asof_join_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "prices").select("ticker", F.col("date").alias("day")).distinct()
    fund = table(spark, sf_dir, "facts").where("fiscal_qtr = 'FY'").groupBy("ticker", "period_end", "filed").agg(F.max("accession").alias("accession"))
    rows = fund.withColumn("known", F.col("filed"))
    return asof.as_of_greatest(days, rows, "ticker", "day", "known", ["period_end", "filed", "accession"])


@query(
    """WITH days AS (SELECT DISTINCT ticker, date AS day FROM {prices}),
    obs AS (SELECT ticker, filed, max(value) AS shares FROM {facts} WHERE concept = 'shares_outstanding' AND value > 0 GROUP BY 1, 2)
    SELECT d.ticker, d.day, o.filed, round(o.shares, 6) AS shares FROM days d ASOF LEFT JOIN obs o ON d.ticker = o.ticker AND d.day >= o.filed""",
    dates="day filed",
)
def asof_last_filed(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "prices").select("ticker", F.col("date").alias("day")).distinct()
    obs = table(spark, sf_dir, "facts").where("concept = 'shares_outstanding' AND value > 0")
    rows = obs.select("ticker", F.col("filed").alias("known"), "filed", F.col("value").alias("shares"))
    out = asof.as_of_last(days, rows.groupBy("ticker", "known", "filed").agg(F.max("shares").alias("shares")), "ticker", "day", "known", ["filed", "shares"])
    return out.withColumn("shares", F.round("shares", 6))


@query(
    """WITH days AS (SELECT DISTINCT ticker, filed AS day FROM {facts})
    SELECT d.ticker, d.day, CASE WHEN d.day - p.date <= 10 THEN p.date END AS price_date, CASE WHEN d.day - p.date <= 10 THEN p.close END AS close
    FROM days d ASOF LEFT JOIN {prices} p ON d.ticker = p.ticker AND d.day >= p.date""",
    dates="day price_date",
)
def asof_max_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "facts").select("ticker", F.col("filed").alias("day")).distinct()
    return asof.as_of_fresh(days, table(spark, sf_dir, "prices"), "ticker", "day", "date", "close")


@query(
    """SELECT ticker, sector, valid_from FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY
      CASE WHEN valid_from <= DATE '1998-06-30' THEN 0 ELSE 1 END,
      CASE WHEN valid_from <= DATE '1998-06-30' THEN DATE '1970-01-01' - valid_from ELSE valid_from - DATE '1970-01-01' END) AS rn
    FROM (SELECT ticker, valid_from, min(sector) AS sector FROM {history} GROUP BY 1, 2)) WHERE rn = 1""",
    dates="valid_from",
)
def scd2_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = table(spark, sf_dir, "history").groupBy("ticker", "valid_from").agg(F.min("sector").alias("sector"))
    return asof.dimension_at(history, F.lit(AS_OF).cast("date")).select("ticker", "sector", "valid_from")


@query(
    """WITH h AS (SELECT ticker, valid_from, min(sector) AS sector FROM {history} GROUP BY 1, 2),
    old AS (SELECT * FROM h WHERE valid_from <= DATE '1999-12-31'),
    fresh AS (SELECT ticker, max(sector) AS sector FROM h WHERE valid_from <= DATE '2000-12-31' GROUP BY 1),
    cur AS (SELECT ticker, arg_max(sector, valid_from) AS sector FROM old GROUP BY 1)
    SELECT ticker, sector, valid_from FROM old UNION ALL
    SELECT f.ticker, f.sector, DATE '2000-12-31' FROM fresh f LEFT JOIN cur c ON f.ticker = c.ticker WHERE f.sector IS DISTINCT FROM c.sector""",
    dates="valid_from",
)
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = table(spark, sf_dir, "history").groupBy("ticker", "valid_from").agg(F.min("sector").alias("sector"))
    fresh = history.where("valid_from <= DATE '2000-12-31'").groupBy("ticker").agg(F.max("sector").alias("sector"))
    old = history.where("valid_from <= DATE '1999-12-31'")
    return asof.merge_dimension(old, fresh, F.lit("2000-12-31").cast("date"), ["sector"]).select("ticker", "sector", "valid_from")


@query(
    """SELECT * FROM {members} WHERE (date_added IS NULL OR date_added <= DATE '1998-06-30')
    AND (date_removed IS NULL OR date_removed > DATE '1998-06-30')""",
    dates="date_added date_removed",
)
def membership_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.members_at(table(spark, sf_dir, "members"), F.lit(AS_OF).cast("date"))


_quarters = "SELECT ticker, period_end AS qend, max(value) AS value FROM {facts} WHERE concept = 'total_assets' GROUP BY 1, 2"


@query(
    f"""WITH q AS ({_quarters}), a AS (SELECT DISTINCT ticker, date AS day FROM {{prices}})
    SELECT ticker, day, near_qend, round(near_value, 6) AS near_value FROM (
      SELECT a.ticker, a.day, q.qend AS near_qend, q.value AS near_value,
        row_number() OVER (PARTITION BY a.ticker, a.day ORDER BY abs(q.qend - a.day) NULLS LAST, q.qend) AS rn
      FROM a LEFT JOIN q ON a.ticker = q.ticker AND abs(q.qend - a.day) <= 30) WHERE rn = 1""",
    dates="day near_qend",
)
def nearest_within_tol(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarters = table(spark, sf_dir, "facts").where("concept = 'total_assets'").groupBy("ticker", F.col("period_end").alias("qend")).agg(F.max("value").alias("value"))
    days = table(spark, sf_dir, "prices").select("ticker", F.col("date").alias("day")).distinct()
    out = asof.nearest(days, quarters, ["ticker"], "day", "qend", 30, ["qend", "value"])
    return out.withColumn("near_value", F.round("near_value", 6))


@query(
    f"""WITH q AS ({_quarters}) SELECT ticker, qend, round(value, 6) AS value, near_qend, round(near_value, 6) AS near_value FROM (
      SELECT a.ticker, a.qend, a.value, b.qend AS near_qend, b.value AS near_value,
        row_number() OVER (PARTITION BY a.ticker, a.qend ORDER BY abs(b.qend - (a.qend - 365)) NULLS LAST, b.qend) AS rn
      FROM q a LEFT JOIN q b ON a.ticker = b.ticker AND abs(b.qend - (a.qend - 365)) <= 35) WHERE rn = 1""",
    dates="qend near_qend",
)
def seasonal_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarters = table(spark, sf_dir, "facts").where("concept = 'total_assets'").groupBy("ticker", F.col("period_end").alias("qend")).agg(F.max("value").alias("value"))
    out = asof.lagged(quarters, ["ticker"], "qend", 365, 35, ["qend", "value"])
    return out.select("ticker", "qend", F.round("value", 6).alias("value"), "near_qend", F.round("near_value", 6).alias("near_value"))


_factor = "(SELECT coalesce(product(s.ratio), 1) FROM {splits} s WHERE s.ticker = p.ticker AND s.ex_date > p.date)"


@query(f"SELECT p.ticker, p.date, round({_factor}, 9) AS factor, round(p.close / {_factor}, 6) AS price FROM {{prices}} p", dates="date")
def split_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = splits.as_traded(table(spark, sf_dir, "prices"), table(spark, sf_dir, "splits"))
    return out.select("ticker", "date", F.round("factor", 9).alias("factor"), F.round("price", 6).alias("price"))


@query(
    """SELECT c.ticker, round(coalesce(product(s.ratio), 1), 9) AS factor FROM {companies} c
    LEFT JOIN {splits} s ON s.ticker = c.ticker AND s.ex_date > DATE '1997-01-01' AND s.ex_date <= DATE '1999-01-01' GROUP BY 1"""
)
def split_window_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "companies").join(splits.split_table(table(spark, sf_dir, "splits")), "ticker", "left")
    factor = splits.factor_between(F.col("splits"), F.lit("1997-01-01").cast("date"), F.lit("1999-01-01").cast("date"))
    return joined.select("ticker", F.round(factor, 9).alias("factor"))


@query(
    """SELECT x, abs(ln(x)) >= ln(1.15) AND len(list_filter(range(1, 11), lambda q: round_even(x * q, 0) >= 1 AND round_even(x * q, 0) <> q
      AND abs(x * q / round_even(x * q, 0) - 1) <= 0.002)) > 0 AS is_split
    FROM (SELECT DISTINCT round(1 + l_tax * 10 * l_linenumber, 3) AS x FROM {lineitem})"""
)
def true_split_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select(F.round(1 + F.col("l_tax") * 10 * F.col("l_linenumber"), 3).alias("x")).distinct()
    return x.select("x", splits.is_true_split(F.col("x")).alias("is_split"))


@query(
    """SELECT ticker, string_agg(CAST(ex_date AS VARCHAR) || ':' || printf('%.8g', ratio), ';' ORDER BY ex_date) AS splits_hash
    FROM (SELECT ticker, ex_date, ratio * (1 + ticker / 7e0) AS ratio FROM {splits}) GROUP BY 1"""
)
def splits_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    uneven = table(spark, sf_dir, "splits").withColumn("ratio", F.expr("ratio * (1 + ticker / 7e0)"))
    return splits.fingerprints(uneven)
