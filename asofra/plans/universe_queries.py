"""Queries of rosters, universes, company names and filing documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reference_data, universe
from ..sources import files, text
from .adapter import table
from .layer_queries import made
from .registry import query

_quarter_ends = """SELECT * FROM (SELECT CAST(last_day(q + INTERVAL 2 MONTH) AS DATE) AS as_of
    FROM (SELECT unnest(generate_series(DATE '1995-10-01', DATE '1998-07-01', INTERVAL 3 MONTH)) AS q)) WHERE as_of BETWEEN DATE '1995-11-15' AND DATE '1998-09-29'"""


@query(_quarter_ends, dates="as_of")
def snapshot_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.snapshot_dates(spark, "1995-11-15", "1998-09-29")


@query(
    f"""WITH d AS ({_quarter_ends}), t AS (SELECT DISTINCT m.ticker, d.as_of FROM {{members}} m JOIN d ON date_added <= as_of AND (date_removed IS NULL OR date_removed > as_of)),
    v AS (SELECT t.ticker, t.as_of, max(CAST(h.valid_from AS VARCHAR) || h.sector) FILTER (h.valid_from <= t.as_of) AS live, min(CAST(h.valid_from AS VARCHAR) || h.sector) AS first
      FROM t LEFT JOIN (SELECT * FROM {{history}} WHERE ticker % 4 > 0) h ON h.ticker = t.ticker GROUP BY 1, 2)
    SELECT ticker, as_of, coalesce(substr(coalesce(live, first), 11), 'Unknown') AS sector FROM v""",
    dates="as_of",
)
def universe_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who belonged to each snapshot day, under which label."""
    days = universe.snapshot_dates(spark, "1995-11-15", "1998-09-29")
    return universe.universe_at(table(spark, sf_dir, "members"), table(spark, sf_dir, "history").where("ticker % 4 > 0"), days, ("sector",))


_listed = "SELECT s_suppkey AS ticker, CASE WHEN s_suppkey % 8 = 0 THEN 'none' ELSE CAST(s_nationkey AS STRING) END AS cik FROM {supplier}"
_stored = "SELECT s_suppkey AS ticker, CAST(s_nationkey AS STRING) AS cik FROM {supplier} WHERE s_suppkey % 4 <> 0"
_renamed = "SELECT s_suppkey AS ticker, s_suppkey - 1 AS file FROM {supplier} WHERE s_suppkey % 16 = 0"


@query(
    f"""WITH w AS ({_listed.replace('STRING', 'VARCHAR')}), f AS ({_stored.replace('STRING', 'VARCHAR')}), a AS ({_renamed}), sib AS (SELECT cik, min(ticker) AS s FROM f GROUP BY 1)
    SELECT w.ticker, w.cik, coalesce(f.ticker, sib.s, a.file) AS file, CASE WHEN f.ticker IS NOT NULL THEN 'own' WHEN sib.s IS NOT NULL THEN 'sibling' WHEN a.file IS NOT NULL THEN 'alias' END AS how
    FROM w LEFT JOIN f ON f.ticker = w.ticker AND f.cik = w.cik LEFT JOIN sib ON sib.cik = w.cik LEFT JOIN (SELECT * FROM a WHERE file IN (SELECT ticker FROM f)) a ON a.ticker = w.ticker"""
)
def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.resolve_files(*(made(spark, sf_dir, t, "supplier") for t in (_listed, _stored, _renamed)))


_companies = "SELECT o_custkey AS ticker, concat('c', CAST(o_orderkey % 3 AS STRING)) AS cik, CAST(o_orderdate AS DATE) AS filed FROM {orders}"


@query(
    f"SELECT ticker, substr(max(CAST(filed AS VARCHAR) || cik), 11) AS cik FROM ({_companies.replace('STRING', 'VARCHAR')}) GROUP BY 1"
)
def newest_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_data.newest_entity(made(spark, sf_dir, _companies, "orders"))


_removed = "SELECT c_custkey AS ticker, CASE WHEN c_custkey % 3 > 0 THEN DATE '2020-01-01' END AS date_removed FROM {customer}"
_heirs = "SELECT c_custkey AS ticker, c_custkey + 1 AS successor FROM {customer} WHERE c_custkey % 5 = 0"


@query(
    f"""SELECT r.ticker, r.date_removed, h.successor, CASE WHEN date_removed IS NULL THEN 'active' WHEN successor IS NOT NULL THEN 'change'
      WHEN r.ticker IN (1, 2, 4) THEN 'bankrupt' WHEN r.ticker IN (7, 8) THEN 'private' ELSE 'acquired' END AS status
    FROM ({_removed}) r LEFT JOIN ({_heirs}) h ON h.ticker = r.ticker""",
    dates="date_removed",
)
def roster_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_data.statuses(made(spark, sf_dir, _removed, "customer"), made(spark, sf_dir, _heirs, "customer"), [1, 2, 4], [7, 8])


_entries = "SELECT o_custkey % 50 AS ticker, CASE WHEN o_custkey % 50 < 20 THEN 'x' ELSE CAST(o_custkey % 2 AS STRING) END AS cik, o_orderkey FROM {orders} WHERE o_orderkey % 40 = 1"


@query(
    f"""WITH e AS ({_entries.replace('STRING', 'VARCHAR')}), g AS (SELECT ticker, count(*) AS occurrences, count(DISTINCT cik) AS ciks FROM e GROUP BY 1)
    SELECT e.ticker, e.cik, e.o_orderkey, occurrences, CASE WHEN occurrences = 1 THEN 'unique' WHEN ciks <= 1 THEN 'reentry' ELSE 'reused' END AS duplicate_class FROM e JOIN g USING (ticker)"""
)
def roster_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_data.duplicate_class(made(spark, sf_dir, _entries, "orders"))


_ciks = [f"SELECT c_custkey AS ticker, CAST(c_nationkey * {k} AS STRING) AS cik FROM {{customer}} WHERE c_custkey % {m} = 0" for k, m in ((100, 3), (7, 2), (1, 5))]


@query(
    "SELECT r.c_custkey AS ticker, lpad(coalesce(a.cik, b.cik, c.cik), 10, '0') AS cik FROM {customer} r "
    + " ".join(f"LEFT JOIN ({t.replace('STRING', 'VARCHAR')}) {n} ON {n}.ticker = r.c_custkey" for n, t in zip("abc", _ciks))
)
def cik_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ticker"))
    return reference_data.resolve_ciks(roster, *(made(spark, sf_dir, t, "customer") for t in _ciks))


_sectors = [f"SELECT c_custkey AS ticker, {s} AS sector, c_mktsegment AS industry FROM {{customer}} WHERE c_custkey % {m} = 0" for s, m in (("'Energy'", 2), ("'Utilities'", 3), ("upper(c_mktsegment)", 5))]


@query(
    "WITH r AS (" + " UNION ALL ".join(f"SELECT *, '{n}' AS source, {o} AS o FROM ({t})" for (n, o), t in zip((("scraped", 1), ("fallback", 2), ("override", 0)), _sectors))
    + ") SELECT ticker, sector, industry, source FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY o) AS rn FROM r) WHERE rn = 1"
)
def sector_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_data.layered_sectors(*(made(spark, sf_dir, t, "customer") for t in _sectors))


_repeated = "SELECT c_custkey % 40 AS ticker, c_name AS sector, c_mktsegment AS source, c_custkey AS place FROM {customer}"
_plain = "SELECT s_suppkey AS ticker, s_name AS sector, 'base' AS source FROM {supplier}"


@query(
    f"""WITH o AS (SELECT ticker, arg_max(sector, place) AS sector, arg_max(source, place) AS source FROM ({_repeated}) GROUP BY 1), b AS ({_plain})
    SELECT b.ticker, coalesce(o.sector, b.sector) AS sector, coalesce(o.source, b.source) AS source FROM b LEFT JOIN o USING (ticker)
    UNION ALL SELECT ticker, sector, source FROM o WHERE ticker NOT IN (SELECT ticker FROM b)"""
)
def repeated_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides of which the last in order wins."""
    return reference_data.with_overrides(made(spark, sf_dir, _plain, "supplier"), made(spark, sf_dir, _repeated, "customer"), "ticker", ["sector", "source"], "place")


_synthetic = "SELECT ticker, concept, period_end, value * 2 AS value FROM {facts} WHERE concept = 'revenue' AND ticker % 2 = 0 AND fiscal_year BETWEEN 1994 AND 1996"
_organic = "SELECT ticker, concept, period_end, value FROM {facts}"


@query(
    f"""WITH s AS ({_synthetic}), w AS (SELECT ticker, concept, min(period_end) AS a, max(period_end) AS b FROM s GROUP BY 1, 2),
    k AS (SELECT o.* FROM ({_organic}) o LEFT JOIN w USING (ticker, concept) WHERE w.a IS NULL OR o.period_end < w.a OR o.period_end > w.b UNION ALL SELECT * FROM s)
    SELECT ticker, concept, count(*) AS n, round(sum(value), 2) AS total FROM k GROUP BY 1, 2"""
)
def synthetic_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reference_data.merge_synthetic(made(spark, sf_dir, _organic, "facts"), made(spark, sf_dir, _synthetic, "facts"))
    return out.groupBy("ticker", "concept").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


_counts = "SELECT l_suppkey AS ticker, CAST(l_orderkey % 200 AS STRING) AS accession, concat('K', CAST(l_partkey % 4 AS STRING)) AS share_class, l_quantity AS value FROM {lineitem} WHERE "


@query(
    f"""WITH c AS ({(_counts + 'l_linenumber = 1').replace('STRING', 'VARCHAR')}), s AS ({(_counts + 'l_linenumber = 2').replace('STRING', 'VARCHAR')}),
    n AS (SELECT ticker, accession, count(DISTINCT share_class) FILTER (o = 'cover') AS c, count(DISTINCT share_class) FILTER (o = 'sheet') AS s
      FROM (SELECT *, 'cover' AS o FROM c UNION ALL SELECT *, 'sheet' FROM s) GROUP BY 1, 2)
    SELECT r.ticker, r.accession, r.source, count(*) AS n, sum(r.value) AS total FROM (SELECT *, 'cover' AS source FROM c UNION ALL SELECT *, 'sheet' FROM s) r
    JOIN n USING (ticker, accession) WHERE r.source = CASE WHEN n.c >= n.s THEN 'cover' ELSE 'sheet' END GROUP BY 1, 2, 3"""
)
def class_count_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    cover, sheet = (made(spark, sf_dir, _counts + f"l_linenumber = {k}", "lineitem") for k in (1, 2))
    out = reference_data.chosen_counts(cover, sheet)
    return out.groupBy("ticker", "accession", "source").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


_earned = """SELECT l_suppkey AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_start, CAST(l_shipdate AS DATE) AS period_end,
    CASE l_linenumber % 3 WHEN 0 THEN 'both' WHEN 1 THEN 'diluted' ELSE 'basic' END AS kind, l_linenumber < 6 AS priced, min(l_extendedprice) AS value FROM {lineitem} GROUP BY 1, 2, 3, 4, 5"""


@query(
    f"""SELECT ticker, period_start, period_end, value, kind AS source FROM (SELECT *, row_number() OVER (PARTITION BY ticker, period_start, period_end
      ORDER BY CASE kind WHEN 'both' THEN 0 WHEN 'diluted' THEN 1 ELSE 2 END, value) AS rn FROM ({_earned}) WHERE priced AND value IS NOT NULL) WHERE rn = 1""",
    dates="period_start period_end",
)
def class_earnings_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_data.class_earnings(made(spark, sf_dir, _earned, "lineitem"))


_names = """SELECT CAST(l_orderkey AS STRING) AS accession, l_quantity AS size, CASE WHEN l_orderkey % 9 = 0 THEN NULL WHEN l_linenumber = 1 AND l_partkey % 5 = 0 THEN concat('co', CAST(l_partkey AS STRING), '_htm.xml')
    WHEN l_linenumber = 2 AND l_partkey % 2 = 0 THEN 'abc-20240331.xml' WHEN l_linenumber = 3 THEN 'abc_lab.xml' WHEN l_linenumber = 4 THEN 'R2.xml'
    WHEN l_linenumber = 5 THEN concat('other', CAST(l_partkey AS STRING), '.xml') ELSE 'page.htm' END AS name FROM {lineitem}"""


@query(
    f"""WITH n AS ({_names.replace('STRING', 'VARCHAR')}), r AS (SELECT *, CASE WHEN name LIKE '%\\_htm.xml' ESCAPE '\\' THEN 0 WHEN name = 'abc-20240331.xml' THEN 1 WHEN name LIKE 'other%' THEN 2 END AS k FROM n),
    g AS (SELECT accession, count(name) AS n, min(k) AS k FROM r GROUP BY 1),
    b AS (SELECT accession, name FROM (SELECT accession, name, row_number() OVER (PARTITION BY accession ORDER BY k, size DESC, name) AS rn FROM r WHERE k IS NOT NULL) WHERE rn = 1)
    SELECT g.accession, b.name AS document, CASE WHEN g.n = 0 THEN 'retry' WHEN b.name IS NULL THEN 'none' ELSE 'found' END AS state FROM g LEFT JOIN b USING (accession)"""
)
def instance_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.instance_documents(made(spark, sf_dir, _names, "lineitem"))


_articles = "SELECT CAST(doc_id % 40 AS BIGINT) AS ticker, doc_id AS rank, source AS title, text FROM {documents}"
_guard = r"""NOT regexp_matches(title, '(?i)^(list of|index of|history of)|\(disambiguation\)') AND NOT regexp_matches(text, '(?i)may refer to')
    AND length(text) >= 80 AND regexp_matches(text, '(?i)\b(company|corporation|inc|firm|manufacturer|bank|holding|provider|retailer|utility)\b')"""


@query(
    f"""WITH a AS (SELECT ticker, arg_min(text, rank) AS text FROM ({_articles}) WHERE {_guard} GROUP BY 1),
    c AS (SELECT c_custkey AS ticker, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS label FROM {{customer}})
    SELECT c.ticker, md5(coalesce(a.text, c.label)) AS description, CASE WHEN a.text IS NOT NULL THEN 'article' WHEN c.label IS NOT NULL THEN 'label' END AS source FROM c LEFT JOIN a USING (ticker)"""
)
def company_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ticker"), F.expr("CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END").alias("sic_description"))
    out = text.company_text(made(spark, sf_dir, _articles, "documents"), companies)
    return out.select("ticker", F.md5(F.col("description").cast("binary")).alias("description"), "source")


@query("SELECT DISTINCT ticker, month FROM (SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS month FROM {prices}) p WHERE NOT EXISTS (SELECT 1 FROM {splits} s WHERE s.ticker = p.ticker AND date_trunc('month', s.ex_date) = p.month)", dates="month")
def resume_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned outputs that do not exist yet."""
    month = lambda name, day: table(spark, sf_dir, name).select("ticker", F.trunc(day, "month").alias("month")).distinct()
    return files.missing(month("prices", "date"), month("splits", "ex_date"), ["ticker", "month"])
