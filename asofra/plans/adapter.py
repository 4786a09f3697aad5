"""Domain tables from the star schema, in SQL that Spark and DuckDB share.

The generated tables have no filings: orders stand in for filings, their
lines for reported facts, suppliers for companies, nations and regions for
industries and sectors. ``{name}`` is a base table or one defined before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")

ANNUAL = (
    "revenue cogs operating_income net_income eps_diluted total_assets stockholders_equity long_term_debt"
    " short_term_debt current_assets current_liabilities total_liabilities accounts_receivable inventory cash"
    " shares_outstanding operating_cashflow capex depreciation sga interest_expense income_tax_expense"
    " dividends_paid buybacks ppe_net retained_earnings"
).split()
QUARTERLY = "revenue net_income eps_diluted total_assets operating_cashflow income_tax_expense".split()
INSTANT = (
    "total_assets stockholders_equity long_term_debt short_term_debt current_assets current_liabilities"
    " total_liabilities accounts_receivable inventory cash shares_outstanding ppe_net retained_earnings"
).split()


def _pick(names: list[str], number: str) -> str:
    cases = " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(names))
    return f"CASE {number} % {len(names)} {cases} END"


_listed = ", ".join(f"'{n}'" for n in INSTANT)

TABLES = {
    # ticker x its sector and industry
    "companies": """
        SELECT s_suppkey AS ticker, n_name AS industry, r_name AS sector
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "filings": f"""
        SELECT l_suppkey AS ticker, CAST(o_orderkey AS STRING) AS accession, CAST(o_orderdate AS DATE) AS filed,
               l_linenumber % 2 = 0 AS annual, l_linenumber, l_partkey, o_orderpriority,
               CASE WHEN l_linenumber % 2 = 0 THEN {_pick(ANNUAL, 'l_partkey')} ELSE {_pick(QUARTERLY, 'l_partkey')} END AS concept,
               CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "periods": """
        SELECT *, CASE WHEN annual THEN make_date(CAST(year(filed) AS INT) - 1, 12, 31)
                  ELSE CAST(CAST(date_trunc('quarter', filed) AS DATE) - INTERVAL 1 DAY AS DATE) END AS period_end
        FROM {filings}""",
    # vintages of facts in long form
    "facts": f"""
        SELECT ticker, accession, filed, concept,
               concat(concept, '_', CAST(l_partkey % 3 AS STRING)) AS tag, CAST(l_partkey % 3 AS INT) AS tag_rank,
               CASE WHEN concept IN ('net_income', 'operating_cashflow', 'retained_earnings') THEN amount ELSE abs(amount) END AS value,
               CASE WHEN concept IN ({_listed}) THEN NULL
                    WHEN NOT annual AND l_linenumber % 4 = 3 THEN CAST(date_trunc('quarter', period_end) AS DATE)
                    ELSE make_date(CAST(year(period_end) AS INT), 1, 1) END AS period_start,
               period_end, CAST(year(period_end) AS INT) AS fiscal_year,
               CASE WHEN annual THEN 'FY' ELSE concat('Q', CAST(quarter(period_end) AS STRING)) END AS fiscal_qtr,
               CASE WHEN annual THEN CASE WHEN o_orderpriority LIKE '1%' THEN '10-K/A' WHEN o_orderpriority LIKE '5%' THEN '8-K' ELSE '10-K' END
                    ELSE CASE WHEN o_orderpriority LIKE '1%' THEN '10-Q/A' WHEN o_orderpriority LIKE '5%' THEN '8-K' ELSE '10-Q' END END AS form,
               'USD' AS unit
        FROM {{periods}}""",
    "prices": """
        SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, CAST(floor(min(l_extendedprice / l_quantity) * 100) AS DOUBLE) / 100 AS close
        FROM {lineitem} WHERE l_quantity > 0 GROUP BY 1, 2""",
    "splits": """
        SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS ex_date,
               CASE max(l_partkey) % 3 WHEN 0 THEN 0.5e0 WHEN 1 THEN 0.25e0 ELSE 2e0 END AS ratio
        FROM {lineitem} WHERE l_discount >= 0.0999 AND l_linenumber = 1 GROUP BY 1, 2""",
    # a dimension with history: a customer's segment by first order of each priority
    "history": """
        SELECT o_custkey AS ticker, o_orderpriority AS sector, min(CAST(o_orderdate AS DATE)) AS valid_from
        FROM {orders} GROUP BY 1, 2""",
    "members": """
        SELECT o_custkey AS ticker, min(CAST(o_orderdate AS DATE)) AS date_added,
               CASE WHEN count(*) > 12 THEN NULL ELSE max(CAST(o_orderdate AS DATE)) END AS date_removed
        FROM {orders} GROUP BY 1""",
    # a panel of numbers by date, company, sector and industry
    "panel": """
        SELECT p.ticker, p.date, c.sector, c.industry, p.close AS level, CAST(c.ticker % 7 AS DOUBLE) * p.close AS size
        FROM {prices} p JOIN {companies} c ON p.ticker = c.ticker""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, or a domain table built from the base tables."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = TABLES[name]
    used = [n for n in (*BASE, *TABLES) if "{" + n + "}" in text]
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in used})


def with_tables(sql: str) -> str:
    """``sql`` for DuckDB with the domain tables it names as leading CTEs."""
    needed: list[str] = []

    def need(text: str) -> None:
        for n in TABLES:
            if "{" + n + "}" in text and n not in needed:
                need(TABLES[n])
                needed.append(n)

    need(sql)
    flat = lambda text: text.format(**{n: n for n in (*BASE, *TABLES)})
    ctes = ", ".join(f"{n} AS ({flat(TABLES[n])})" for n in needed)
    body = flat(sql).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
