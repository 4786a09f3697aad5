"""Queries of the cross-section, feature, report and text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import cross_section as cs
from ..operators import daily, features, periods, reference_data, splits, validate
from ..operators.asof import members_at
from ..sources import text
from ..streaming import incremental
from .adapter import ANNUAL, table
from .registry import query

MONTH = "SELECT ticker, sector, industry, CAST(date_trunc('month', date) AS DATE) AS month, avg(level) AS level, max(size) AS size FROM {panel} GROUP BY 1, 2, 3, 4"


def exact_mean(cents: str) -> Column:
    """The mean of whole cents: of equal sets alike in any order of rows, so
    that a value that equals its group's median is never above it."""
    whole = F.sum(F.round(F.col(cents) * 100).cast("decimal(28,0)")).cast("double")
    return whole / (100.0 * F.count(cents))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = table(spark, sf_dir, "panel")
    return panel.groupBy("ticker", "sector", "industry", F.trunc("date", "month").alias("month")).agg(
        exact_mean("level").alias("level"), F.max("size").alias("size")
    )


@query(
    f"""WITH m AS ({MONTH}) SELECT ticker, month, round(level - avg(level) OVER (PARTITION BY month, sector), 6) + 0e0 AS level FROM m""",
    dates="month",
)
def sector_demean(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cs.demeaned(monthly(spark, sf_dir), "level", ["month", "sector"])
    return out.select("ticker", "month", F.round("level", 6).alias("level"))


@query(
    f"""WITH m AS ({MONTH}) SELECT ticker, month, CASE WHEN count(level) OVER (PARTITION BY month, sector) >= 3
      THEN CASE WHEN level > median(level) OVER (PARTITION BY month, sector) THEN 1e0 ELSE 0e0 END END AS level FROM m""",
    dates="month",
)
def mohanram_binarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cs.against_median(monthly(spark, sf_dir), {"level": True}, ["month", "sector"])
    return out.select("ticker", "month", "level")


@query(
    f"""WITH m AS ({MONTH}) SELECT month, industry, round(sum(size * size) / (sum(size) * sum(size)), 6) AS herf, count(*) AS n
    FROM m WHERE size > 0 GROUP BY 1, 2""",
    dates="month",
)
def herfindahl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cs.herfindahl(monthly(spark, sf_dir), "size", ["month", "industry"]).withColumn("herf", F.round("herf", 6))


@query(
    f"""WITH m AS ({MONTH}) SELECT month, industry, round(CASE WHEN abs(sum(level)) >= 1e-9 THEN (sum(size) - sum(level)) / abs(sum(level)) END, 6) AS growth
    FROM m WHERE size IS NOT NULL AND level IS NOT NULL GROUP BY 1, 2""",
    dates="month",
)
def industry_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cs.group_growth(monthly(spark, sf_dir), "size", "level", ["month", "industry"]).withColumn("growth", F.round("growth", 6))


def robust_sql(groups: str, pool: str = "") -> str:
    return f"""ends AS (SELECT {groups}, quantile_cont(value, 0.025) AS lo, quantile_cont(value, 0.975) AS hi, count(value) AS n FROM long GROUP BY {groups}),
    w AS (SELECT long.*, n, CASE WHEN value IS NOT NULL THEN least(greatest(value, lo), hi) END AS w FROM long JOIN ends USING ({groups})),
    {pool or f"pool AS (SELECT {groups}, w FROM w)"},
    mid AS (SELECT {groups}, median(w) AS med, count(w) AS m FROM pool GROUP BY {groups}),
    sp AS (SELECT {groups}, 1.4826e0 * median(abs(w - med)) AS mad FROM pool JOIN mid USING ({groups}) GROUP BY {groups}),
    z AS (SELECT w.*, CASE WHEN n >= 3 AND m >= 3 AND mad >= 1e-12 AND w IS NOT NULL THEN least(greatest((w - med) / mad, -5), 5) END AS z
      FROM w JOIN mid USING ({groups}) JOIN sp USING ({groups}))"""


_long = f"m AS ({MONTH}), long AS (SELECT ticker, month, sector, 'level' AS name, level AS value FROM m UNION ALL SELECT ticker, month, sector, 'size', size FROM m)"


@query(f"WITH {_long}, {robust_sql('month, name')} SELECT ticker, month, name, round(z, 6) + 0e0 AS z FROM z", dates="month")
def robust_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = cs.melt(monthly(spark, sf_dir), ["ticker", "month", "sector"], ["level", "size"])
    return cs.robust_scores(long, ["month", "name"]).select("ticker", "month", "name", F.round("z", 6).alias("z"))


_pool = """past AS (SELECT month AS p, name, w FROM w WHERE n >= 3), times AS (SELECT DISTINCT month FROM long),
    pool AS (SELECT month, name, w FROM times JOIN past ON p <= month)"""


@query(f"WITH {_long}, {robust_sql('month, name', _pool)} SELECT ticker, month, name, round(z, 6) + 0e0 AS z FROM z", dates="month")
def expanding_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = cs.melt(monthly(spark, sf_dir), ["ticker", "month", "sector"], ["level", "size"])
    return cs.expanding_scores(long, "month", ["name"]).select("ticker", "month", "name", F.round("z", 6).alias("z"))


SECTOR_SCORES = """mid AS (SELECT {g}, median(value) AS med, count(value) AS n FROM long GROUP BY {g}),
    sp AS (SELECT {g}, 1.4826e0 * median(abs(value - med)) AS mad FROM long JOIN mid USING ({g}) GROUP BY {g}),
    w AS (SELECT long.*, n, CASE WHEN n < 3 OR mad < 1e-12 THEN value WHEN value IS NOT NULL THEN least(greatest(value, med - 3 * mad), med + 3 * mad) END AS w
      FROM long JOIN mid USING ({g}) JOIN sp USING ({g})),
    mo AS (SELECT {g}, avg(w) AS mean, stddev_samp(w) AS sd FROM w GROUP BY {g}),
    z AS (SELECT w.*, CASE WHEN n >= 5 AND sd >= 1e-12 AND w IS NOT NULL THEN least(greatest((w - mean) / sd, -3), 3) END AS z FROM w JOIN mo USING ({g}))""".replace(
    "{g}", "month, sector, name"
)


@query(f"WITH {_long}, {SECTOR_SCORES} SELECT ticker, month, name, round(z, 6) + 0e0 AS z FROM z", dates="month")
def cs_sector_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = cs.melt(monthly(spark, sf_dir), ["ticker", "month", "sector"], ["level", "size"])
    return cs.sector_scores(long, ["month", "sector", "name"]).select("ticker", "month", "name", F.round("z", 6).alias("z"))


@query(
    f"""WITH m AS ({MONTH}), ok AS (SELECT month FROM m GROUP BY 1 HAVING count(DISTINCT ticker) >= 10)
    SELECT month, sector, round(median(level), 6) AS level, round(median(size), 6) AS size FROM m WHERE month IN (SELECT month FROM ok) GROUP BY 1, 2""",
    dates="month",
)
def sector_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cs.medians(monthly(spark, sf_dir), ["level", "size"], ["month", "sector"], "month", "ticker")
    return out.select("month", "sector", F.round("level", 6).alias("level"), F.round("size", 6).alias("size"))


def rolling_sql(source: str, keys: str, date: str, window: int, least: int) -> str:
    frame = f"OVER (PARTITION BY {keys} ORDER BY {date} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    sd = "CASE WHEN count({0}) {1} = 1 THEN 0 ELSE stddev_samp({0}) {1} END"
    return f"""r1 AS (SELECT *, avg(value) {frame} AS mean, {sd.format('value', frame)} AS sd FROM {source}),
    r2 AS (SELECT *, CASE WHEN sd > 0 AND value IS NOT NULL THEN least(greatest(value, mean - 3 * sd), mean + 3 * sd) ELSE value END AS w FROM r1),
    r3 AS (SELECT *, avg(w) {frame} AS m2, {sd.format('w', frame)} AS s2, count(w) {frame} AS n2 FROM r2),
    rz AS (SELECT *, CASE WHEN value IS NOT NULL AND n2 >= {least} AND s2 >= 1e-12 THEN least(greatest((w - m2) / s2, -3), 3) END AS z FROM r3)"""


@query(
    f"WITH s AS (SELECT ticker, date, level AS value FROM {{panel}}), {rolling_sql('s', 'ticker', 'date', 252, 60)} SELECT ticker, date, round(z, 5) + 0e0 AS z FROM rz",
    dates="date",
)
def rolling_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = table(spark, sf_dir, "panel").withColumnRenamed("level", "value")
    out = cs.rolling_scores(panel, ["ticker"], "date", "value", window=252, least=60)
    return out.select("ticker", "date", F.round("z", 5).alias("z"))


@query(
    f"""WITH m AS ({MONTH}), long AS (SELECT ticker, month, sector, 'level' AS name, level AS value FROM m),
    {SECTOR_SCORES}, {rolling_sql('long', 'ticker', 'month', 24, 6)},
    ok AS (SELECT month FROM m GROUP BY 1 HAVING count(DISTINCT ticker) >= 10),
    med AS (SELECT month, sector, median(level) AS value FROM m WHERE month IN (SELECT month FROM ok) GROUP BY 1, 2),
    sec AS (SELECT * FROM (WITH {rolling_sql('med', 'sector', 'month', 24, 6)} SELECT month, sector, z FROM rz))
    SELECT m.ticker, m.month AS date, m.sector, m.size, round(rz.z, 5) + 0e0 AS ts_own_level, round(sec.z, 5) + 0e0 AS ts_sec_level, round(z.z, 5) + 0e0 AS cs_sec_level
    FROM m LEFT JOIN rz ON rz.ticker = m.ticker AND rz.month = m.month LEFT JOIN sec ON sec.month = m.month AND sec.sector = m.sector
    LEFT JOIN z ON z.ticker = m.ticker AND z.month = m.month""",
    dates="date",
)
def feature_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = monthly(spark, sf_dir).withColumnRenamed("month", "date")
    out = features.assemble(daily, ["level"], ["size"], window=24, least=6)
    return out.select("ticker", "date", "sector", "size", *(F.round(f"{p}_level", 5).alias(f"{p}_level") for p in ("ts_own", "ts_sec", "cs_sec")))


_cover = "SELECT *, nullif(level, 0) AS a, CASE WHEN ticker % 3 = 0 THEN NULL ELSE size END AS b FROM {panel}"


@query(
    f"""WITH p AS ({_cover}), g AS (SELECT sector, count(*) AS n, count(a) AS a, count(b) AS b FROM p GROUP BY 1),
    l AS (SELECT sector, n, 'a' AS name, a AS n_known FROM g UNION ALL SELECT sector, n, 'b', b FROM g)
    SELECT sector, n, name, n_known, round(100.0 * n_known / n, 6) AS percent,
      CASE WHEN 100.0 * n_known / n >= 90 THEN 'high' WHEN 100.0 * n_known / n >= 50 THEN 'medium' ELSE 'low' END AS tier FROM l"""
)
def coverage_by_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = table(spark, sf_dir, "panel").withColumns({"a": F.expr("nullif(level, 0)"), "b": F.when(F.col("ticker") % 3 != 0, F.col("size"))})
    return validate.coverage(panel, ["a", "b"], "sector").withColumn("percent", F.round("percent", 6))


@query(
    """WITH k AS (SELECT ticker, concept, count(DISTINCT period_end) AS periods FROM {facts} WHERE value IS NOT NULL GROUP BY 1, 2),
    s AS (SELECT ticker, unnest([""" + ", ".join(f"'{c}'" for c in ANNUAL) + """]) AS concept FROM {companies})
    SELECT s.ticker, s.concept, coalesce(k.periods, 0) AS periods FROM s LEFT JOIN k ON k.ticker = s.ticker AND k.concept = s.concept"""
)
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.concept_grid(table(spark, sf_dir, "facts"), table(spark, sf_dir, "companies"), ANNUAL)


@query(
    f"""WITH {_long}, {robust_sql('month, name')}, a AS (SELECT name, median(z) AS m, max(abs(z)) AS top, count(z) AS n, count(*) FILTER (isnan(z)) AS nan FROM z GROUP BY 1),
    b AS (SELECT name, 1.4826e0 * median(abs(z - m)) AS mad FROM z JOIN a USING (name) GROUP BY 1)
    SELECT name, 'centered' AS "check", abs(m) < 0.05 AS passed FROM a UNION ALL SELECT name, 'scaled', mad > 0.9 AND mad < 1.1 FROM b
    UNION ALL SELECT name, 'bounded', top <= 5 FROM a UNION ALL SELECT name, 'no_nan', nan = 0 FROM a UNION ALL SELECT name, 'present', n > 0 FROM a"""
)
def score_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = cs.melt(monthly(spark, sf_dir), ["ticker", "month", "sector"], ["level", "size"])
    return validate.score_checks(cs.robust_scores(long, ["month", "name"]), ["name"])


@query(
    """WITH near AS (SELECT s.ticker, s.ex_date, s.ratio, p.date, p.close AS v, p.date - s.ex_date AS gap FROM {splits} s JOIN {prices} p
      ON p.ticker = s.ticker AND p.date - s.ex_date BETWEEN -14 AND 14),
    a AS (SELECT ticker, ex_date, ratio, arg_max(v, date) FILTER (gap < 0) AS before, arg_min(v, date) FILTER (gap >= 0) AS after FROM near GROUP BY 1, 2, 3)
    SELECT ticker, ex_date, ratio, before, after, CAST(abs(ln(CASE WHEN abs(before) >= 1e-9 THEN after / before END)) <= ln(1.2) AS VARCHAR) AS consistent FROM a""",
    dates="ex_date",
)
def split_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = table(spark, sf_dir, "prices").withColumnRenamed("close", "market_cap")
    out = validate.split_consistency(daily, table(spark, sf_dir, "splits"))
    return out.withColumn("consistent", F.col("consistent").cast("string"))


@query(
    """WITH c AS (SELECT l_suppkey AS ticker, o_orderpriority AS label, count(*) AS n FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY 1, 2)
    SELECT ticker, label, n FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY n DESC, label) AS rn FROM c) WHERE rn = 1"""
)
def modal_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return reference_data.modal(rows.select(F.col("l_suppkey").alias("ticker"), F.col("o_orderpriority").alias("label")), ["ticker"], "label")


_classes = """SELECT ticker, accession, period_end, concat('Class ', CASE l_partkey % 2 WHEN 0 THEN 'A' ELSE 'B' END) AS share_class, l_partkey % 2 = 0 AS priced, max(amount) AS value
  FROM {periods} WHERE annual AND amount > 0 GROUP BY 1, 2, 3, 4, 5"""


@query(
    f"""WITH c AS ({_classes}), e AS (SELECT ticker, period_end, priced, share_class, max(value) AS value FROM c GROUP BY 1, 2, 3, 4),
    conv AS (SELECT o.ticker, o.share_class, median(o.value / p.value) AS conversion FROM e o JOIN e p ON o.ticker = p.ticker AND o.period_end = p.period_end
      WHERE NOT o.priced AND p.priced AND abs(p.value) >= 0.05 GROUP BY 1, 2),
    d AS (SELECT ticker, accession, period_end, count(DISTINCT share_class) AS n_classes FROM c GROUP BY 1, 2, 3),
    b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, accession ORDER BY n_classes DESC, period_end DESC) AS rn FROM d) WHERE rn = 1)
    SELECT b.ticker, b.accession, b.period_end, round(CASE WHEN bool_and(c.priced OR conv.conversion IS NOT NULL)
      THEN sum(c.value * CASE WHEN c.priced THEN 1 ELSE conv.conversion END) END, 4) AS shares, b.n_classes
    FROM b JOIN c ON c.ticker = b.ticker AND c.accession = b.accession AND c.period_end = b.period_end
    LEFT JOIN conv ON conv.ticker = c.ticker AND conv.share_class = c.share_class GROUP BY 1, 2, 3, 5""",
    dates="period_end",
)
def class_synthesis(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spark.sql(_classes, periods=table(spark, sf_dir, "periods"))
    eps = counts.groupBy("ticker", "period_end", "priced", "share_class").agg(F.max("value").alias("value")).withColumn("period_start", F.lit(0))
    out = reference_data.class_shares(counts, reference_data.class_conversions(eps))
    return out.withColumn("shares", F.round("shares", 4))


_base = "SELECT s_suppkey AS ticker, s_name AS sector, 'base' AS source FROM {supplier} WHERE s_acctbal >= 2000"
_over = "SELECT s_suppkey AS ticker, upper(s_name) AS sector, 'override' AS source FROM {supplier} WHERE s_acctbal < 5000"


@query(
    f"""WITH b AS ({_base}), o AS ({_over}) SELECT b.ticker, coalesce(o.sector, b.sector) AS sector, coalesce(o.source, b.source) AS source
    FROM b LEFT JOIN o ON o.ticker = b.ticker UNION ALL SELECT * FROM o WHERE ticker NOT IN (SELECT ticker FROM b)"""
)
def semi_anti_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return reference_data.with_overrides(spark.sql(_base, supplier=supplier), spark.sql(_over, supplier=supplier), "ticker", ["sector", "source"])


@query(
    """SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier})
    UNION ALL SELECT 'union_all', count(*) FROM (SELECT c_nationkey AS k FROM {customer} UNION ALL SELECT s_nationkey FROM {supplier})
    UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_nationkey AS k FROM {customer} INTERSECT SELECT s_nationkey FROM {supplier})
    UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey AS k FROM {customer} EXCEPT SELECT s_suppkey FROM {supplier})"""
)
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    x, y = a.select(F.col("c_nationkey").alias("k")), b.select(F.col("s_nationkey").alias("k"))
    made = {
        "union": x.union(y).distinct(), "union_all": x.union(y), "intersect": x.intersect(y),
        "except": a.select(F.col("c_custkey").alias("k")).subtract(b.select(F.col("s_suppkey").alias("k"))),
    }
    out = None
    for op, rows in made.items():
        one = rows.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n")
        out = one if out is None else out.union(one)
    return out


@query(f"WITH m AS ({MONTH}) SELECT ticker, month, round(level, 6) AS level FROM m ORDER BY m.level DESC, ticker, month LIMIT 10", dates="month")
def topk_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cs.top(monthly(spark, sf_dir), "level", 10, "ticker", "month").select("ticker", "month", F.round("level", 6).alias("level"))


@query(
    f"""WITH m AS ({MONTH}), t AS (SELECT month, quantile_cont(level, 0.9) AS cut FROM m GROUP BY 1)
    SELECT ticker, m.month, round(level, 6) AS level FROM m JOIN t ON t.month = m.month WHERE level >= cut""",
    dates="month",
)
def quantile_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cs.above_quantile(monthly(spark, sf_dir), "level", 0.9, ["month"]).select("ticker", "month", F.round("level", 6).alias("level"))


@query("SELECT sector, round(median(level), 6) AS level, round(median(size), 6) AS size, count(*) AS n FROM {panel} GROUP BY 1")
def sector_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cs.profile(table(spark, sf_dir, "panel"), ["level", "size"], ["sector"])
    return out.withColumns({c: F.round(c, 6) for c in ("level", "size")})


@query("SELECT user_id, k, count(*) AS n FROM (SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM {events}) GROUP BY 1, 2")
def json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").select("user_id", F.from_json("props", "map<string,long>").alias("m"))
    return parsed.select("user_id", F.explode("m").alias("name", "k")).groupBy("user_id", "k").agg(F.count("*").alias("n"))


@query(
    r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1),
      '<[^>]*>', ' ', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '[ \t\r\n]+', ' ', 'g')) AS title,
      len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS links FROM {pages}"""
)
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = text.without_markup(F.regexp_extract("html", r"<title>([^<]*)</title>", 1))
    links = F.size(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).cast("long")
    return table(spark, sf_dir, "pages").select("page_id", title.alias("title"), links.alias("links"))


@query(
    r"""SELECT doc_id, NOT regexp_matches(source, '(?i)^(list of|index of|history of)|\(disambiguation\)') AND NOT regexp_matches(text, '(?i)may refer to')
      AND length(text) >= 80 AND regexp_matches(text, '(?i)\b(company|corporation|inc|firm|manufacturer|bank|holding|provider|retailer|utility)\b') AS company_like FROM {documents}"""
)
def company_like_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.is_company_like(F.col("source"), F.col("text")).alias("company_like"))


@query(
    """WITH last AS (SELECT user_id, max(ts) AS cursor FROM {events} WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1)
    SELECT e.user_id, count(*) AS fresh, round(sum(e.value), 4) AS total FROM {events} e LEFT JOIN last l ON l.user_id = e.user_id
    WHERE l.cursor IS NULL OR e.ts > l.cursor GROUP BY 1"""
)
def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnsRenamed({"user_id": "ticker", "ts": "date"})
    cursor = events.where("date < TIMESTAMP_NTZ '2024-01-15'").groupBy("ticker").agg(F.max("date").alias("last_daily_date"))
    plan = events.select("ticker").distinct().join(cursor, "ticker", "left").withColumn("action", F.lit("append"))
    fresh = incremental.fresh_rows(events, plan).withColumnRenamed("ticker", "user_id")
    return fresh.groupBy("user_id").agg(F.count("*").alias("fresh"), F.round(F.sum("value"), 4).alias("total"))


_snap = "SELECT ticker, max(level) AS level, max(size) AS size FROM {{panel}} WHERE date <= DATE '{0}' GROUP BY 1"


@query(
    f"""WITH a AS ({_snap.format('1996-06-30').replace('{{', '{').replace('}}', '}')}), b AS ({_snap.format('1999-06-30').replace('{{', '{').replace('}}', '}')}),
    la AS (SELECT ticker, 'level' AS name, level AS v FROM a UNION ALL SELECT ticker, 'size', size FROM a),
    lb AS (SELECT ticker, 'level' AS name, level AS v FROM b UNION ALL SELECT ticker, 'size', size FROM b)
    SELECT coalesce(la.ticker, lb.ticker) AS ticker, coalesce(la.name, lb.name) AS name, la.v AS left_value, lb.v AS right_value
    FROM la FULL OUTER JOIN lb ON la.ticker = lb.ticker AND la.name = lb.name WHERE la.v IS DISTINCT FROM lb.v"""
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = table(spark, sf_dir, "panel")
    a, b = (panel.where(f"date <= DATE '{d}'").groupBy("ticker").agg(F.max("level").alias("level"), F.max("size").alias("size")) for d in ("1996-06-30", "1999-06-30"))
    return validate.difference(a, b, ["ticker"], ["level", "size"])


@query(
    """SELECT user_id, session, min(ts) AS first_ts, count(*) AS n FROM (
      SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
        SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM {events})) GROUP BY 1, 2""",
    dates="first_ts",
)
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").withColumn("_before", F.lag("ts").over(order))
    fresh = F.when(F.expr("ts - _before <= INTERVAL 6 HOURS"), 0).otherwise(1)
    out = rows.withColumn("session", F.sum(fresh).over(order))
    return out.groupBy("user_id", "session").agg(F.min("ts").alias("first_ts"), F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(DISTINCT ticker) AS tickers FROM {members} WHERE date_added <= DATE '1997-03-31' AND (date_removed IS NULL OR date_removed > DATE '1997-03-31')")
def universe_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = members_at(table(spark, sf_dir, "members"), F.lit("1997-03-31").cast("date"))
    return found.agg(F.count("*").alias("n"), F.countDistinct("ticker").alias("tickers"))


@query(None)
def daily_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense daily layer of all companies: a year's row as known when its
    last fact was filed (the stand-in filings hold a few facts each), carried
    forward and priced."""
    facts, cuts = table(spark, sf_dir, "facts"), table(spark, sf_dir, "splits")
    years = facts.where("fiscal_qtr = 'FY'").groupBy("ticker", "fiscal_year").agg(F.max("filed").alias("as_of"))
    fund = daily.fund_layer(facts, cuts, table(spark, sf_dir, "companies"), years)
    eps = facts.where("concept = 'eps_diluted'").join(splits.split_table(cuts), "ticker", "left")
    eps = eps.withColumn("value", F.col("value") * splits.factor_after(F.col("splits"), F.col("filed"))).drop("splits")
    return daily.daily_layer(
        table(spark, sf_dir, "prices"), fund, daily.pershare_layer(facts), cuts, daily.FUNDAMENTAL, periods.ttm_eps(eps, ["ticker"])
    )


_shares_rank = "CASE tag WHEN 'MulticlassSharesOutstanding' THEN 0 WHEN 'EntityCommonStockSharesOutstanding' THEN 1 WHEN 'MulticlassSharesOutstandingBS' THEN 2 ELSE 3 END"


@query(
    f"""SELECT ticker, filed AS filed_date, period_end, round(value, 4) AS shares FROM (SELECT *, row_number() OVER (PARTITION BY ticker, filed
      ORDER BY {_shares_rank}, period_end DESC, value DESC) AS rn FROM {{facts}} WHERE concept = 'shares_outstanding' AND value > 0 AND form <> '8-K') WHERE rn = 1""",
    dates="filed_date period_end",
)
def pershare_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.pershare_layer(table(spark, sf_dir, "facts")).withColumn("shares", F.round("shares", 4))


@query(
    """WITH f AS (SELECT ticker, max(filed) AS last_filed_date FROM {facts} GROUP BY 1), p AS (SELECT ticker, max(date) AS last_price_date FROM {prices} GROUP BY 1)
    SELECT m.ticker, f.last_filed_date, p.last_price_date,
      CASE WHEN m.date_removed IS NOT NULL THEN 'removed' WHEN f.last_filed_date IS NULL THEN 'needs-backfill' WHEN p.last_price_date IS NULL THEN 'price-purged' ELSE 'ok' END AS status
    FROM {members} m LEFT JOIN f ON f.ticker = m.ticker LEFT JOIN p ON p.ticker = m.ticker""",
    dates="last_filed_date last_price_date",
)
def update_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table(spark, sf_dir, "prices")
    out = incremental.manifest(table(spark, sf_dir, "members"), table(spark, sf_dir, "facts"), prices, prices, table(spark, sf_dir, "splits"))
    return out.select("ticker", "last_filed_date", "last_price_date", "status")
