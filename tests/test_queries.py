"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from asofra.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    found = duckdb.connect()
    for t in TABLES:
        found.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return found


def plain(value):
    return f"{value:.5g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = con.execute(f"SELECT {quoted} FROM ({SQL[name]})").fetchall()
    rows = [tuple(map(plain, r)) for r in got.select(*columns).collect()]
    assert sorted(rows) == sorted(tuple(map(plain, r)) for r in want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_reach_the_scan(spark):
    plan = QUERIES["scan_filter_project"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey" in plan and "l_shipdate" not in plan
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan


def test_equal_means_are_not_above_their_median(spark, tmp_path):
    """Thirty companies with the same prices on other days: the order in which
    a month's prices are added up must not put any above the median."""
    prices = (0.1, 0.2, 0.3, 17.93, 1e7 + 0.01)
    lines = [(k, f"1997-03-{(7 * k + 5 * i) % 28 + 1:02}", p) for k in range(30) for i, p in enumerate(prices)]
    lines = spark.createDataFrame(lines, "l_suppkey long, l_shipdate string, l_extendedprice double")
    lines.selectExpr("l_suppkey", "CAST(l_shipdate AS TIMESTAMP) l_shipdate", "l_extendedprice", "1D l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(30).selectExpr("id s_suppkey", "0L s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(1).selectExpr("id n_nationkey", "'N' n_name", "0L n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(1).selectExpr("id r_regionkey", "'R' r_name").write.parquet(f"{tmp_path}/region.parquet")
    got = entry.queries()["mohanram_binarize"](spark, str(tmp_path)).collect()
    assert len(got) == 30 and {r.level for r in got} == {0.0}
