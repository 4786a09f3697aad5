"""Readers, snapshots, features, updates and providers on stored layers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from asofra import api
from asofra.operators import asof, market, reference_data, splits
from asofra.sources import files, text
from asofra.streaming import incremental
from tests.test_operators import D, company


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Three companies with the same facts, priced for forty days."""
    path = str(tmp_path_factory.mktemp("layers"))
    one = company(spark)
    tickers = ["T", "U", "V"]
    facts = one.where("FALSE")
    for t in tickers:
        facts = facts.unionByName(one.withColumn("ticker", F.lit(t)))
    facts.write.parquet(f"{path}/facts")
    days = [D("2024-03-01") + dt.timedelta(k) for k in range(40)]
    prices = spark.createDataFrame([(t, d, 50.0 + i) for t in tickers for i, d in enumerate(days)], "ticker string, date date, close double")
    prices.where("date < DATE '2024-04-01'").write.parquet(f"{path}/prices")
    prices.where("date >= DATE '2024-04-01'").write.parquet(f"{path}/later")
    spark.createDataFrame([("T", D("2019-01-01"), 0.5)], "ticker string, ex_date date, ratio double").write.parquet(f"{path}/splits")
    spark.createDataFrame([(t, "Technology", "Chips") for t in tickers], "ticker string, sector string, industry string").write.parquet(f"{path}/companies")
    spark.createDataFrame([("T", None, None), ("U", None, D("2024-01-15")), ("V", D("2024-02-15"), None)], "ticker string, date_added date, date_removed date").write.parquet(f"{path}/members")
    spark.createDataFrame([("T", D("2020-01-01"), "Energy", "Oil"), ("T", D("2024-04-01"), "Technology", "Chips"), ("U", D("2020-01-01"), "Energy", "Oil")], "ticker string, valid_from date, sector string, industry string").write.parquet(f"{path}/history")
    api.build_timeseries(spark, path)
    return path


def test_daily_rows_carry_all_fundamentals(spark, root):
    rows = api.load_ticker_timeseries(spark, root, "T")
    assert rows.count() == 31 and set(api.CARRIED) <= set(rows.columns) and {"eps_ttm", "pe_ttm", "quarter_q"} <= set(rows.columns)
    cross = api.load_daily_cross_section(spark, root, "2024-03-05")
    assert cross.count() == 3 and "ing_rev_lag1" not in cross.columns and cross.first().sector == "Technology"
    assert api.load_daily_cross_section(spark, root, "2024-03-05", zscore=True).count() == 3


def test_features_grow_with_the_days(spark, root):
    api.build_all_features(spark, root, window=20, least=3, least_tickers=2)
    assert api.load_features(spark, root, ticker="T").count() == 31
    assert api.update_features(spark, root, window=20, least=3, least_tickers=2) == 0
    spark.read.parquet(f"{root}/later").where("ticker = 'T' OR date < DATE '2024-04-05'").write.mode("append").parquet(f"{root}/prices")
    # U has left the roster and is not advanced
    assert api.run_incremental_update(spark, root, "2024-04-12") == 9 + 4
    assert api.run_incremental_update(spark, root, "2024-04-12") == 0
    assert api.update_features(spark, root, window=20, least=3, least_tickers=2) == 13
    assert api.load_features(spark, root, day="2024-04-02").count() == 2
    log = spark.read.option("header", True).csv(f"{root}/log")
    assert sorted(r.tiers for r in log.collect()) == ["D", "MWD"]


def test_a_new_split_rebuilds_one_ticker(spark, root):
    before = {r.date: r.price for r in api.load_ticker_timeseries(spark, root, "V").collect()}
    spark.createDataFrame([("V", D("2024-03-20"), 0.5)], "ticker string, ex_date date, ratio double").write.mode("append").parquet(f"{root}/splits")
    failed = spark.createDataFrame([("V", "failed")], "ticker string, state string")
    assert api.run_incremental_update(spark, root, "2024-04-13", failed) == 0
    assert {r.date: r.price for r in api.load_ticker_timeseries(spark, root, "V").collect()} == before
    assert api.run_incremental_update(spark, root, "2024-04-14") == 0
    after = {r.date: r.price for r in api.load_ticker_timeseries(spark, root, "V").collect()}
    assert after.keys() == before.keys() and after[D("2024-03-19")] == 2 * before[D("2024-03-19")] and after[D("2024-03-20")] == before[D("2024-03-20")]
    assert api.load_ticker_timeseries(spark, root, "T").count() == 40


def test_snapshots_of_a_universe(spark, root):
    api.build_historical_snapshots(spark, root, "2023-12-01", "2024-04-30")
    raw = {(r.as_of, r.ticker): r.sector for r in api.load_history(spark, root, "2030-01-01").select("as_of", "ticker", "sector").collect()}
    assert raw == {(D("2023-12-31"), "T"): "Energy", (D("2023-12-31"), "U"): "Energy", (D("2024-03-31"), "T"): "Energy", (D("2024-03-31"), "V"): "Unknown"}
    assert api.load_snapshot(spark, root, "2024-03-31").count() == 2 and api.load_snapshot(spark, root, "2024-06-30") is None
    assert api.load_snapshot(spark, root, "2024-03-31", "zscore") is not None and api.list_snapshots(spark, root).count() == 2
    api.build_historical_snapshots(spark, root, "2023-12-01", "2024-04-30")
    assert api.load_history(spark, root, "2030-01-01").count() == 4
    with pytest.raises(ValueError):
        api.load_snapshot(spark, root, "2024-03-31", "other")
    assert api.demo_ticker(spark, root, "T", ["size"]).count() > 0


def test_fundamentals_by_cik(spark):
    facts = company(spark).withColumn("cik", F.lit("0000000007"))
    assert api.get_fundamentals(facts, cik="7", allow_restated=True).count() > 0
    assert api.get_fundamentals(facts, "OTHER", "2024-03-01", cik="7").count() > 0
    assert api.get_fundamentals(facts, "OTHER", "2024-03-01", cik="8").count() == 0


def test_provider_symbols_and_factors(spark):
    df = spark.createDataFrame([("BRK.B",), ("FB",)], "t string")
    assert [r.s for r in df.select(market.provider_symbol(F.col("t"), {"FB": "META"}).alias("s")).collect()] == ["BRK-B", "META"]
    vendor = spark.createDataFrame([("T", D("2024-01-02"), f) for f in (4.0, 1.0, 1.237, None, -2.0, 1.5)], "ticker string, date date, split_factor double")
    assert sorted(r.ratio for r in market.split_events(vendor).collect()) == [0.25, pytest.approx(2 / 3)]
    cuts = spark.createDataFrame([("T", D("2024-01-02"), r) for r in (1 / 3, 0.5)], "ticker string, ex_date date, ratio double")
    assert splits.fingerprints(cuts.where("ratio < 0.4")).first().splits_hash == "2024-01-02:0.33333333"


def test_nearest_keeps_repeated_rows_and_ties(spark):
    left = spark.createDataFrame([("A", D("2024-01-10"))] * 2 + [("B", D("2024-01-10")), ("A", None), (None, D("2024-01-10"))], "k string, at date")
    right = spark.createDataFrame([("A", D("2024-01-08"), 2.0), ("A", D("2024-01-08"), 1.0), ("A", D("2024-01-12"), 3.0), (None, D("2024-01-10"), 9.0)], "k string, d date, v double")
    got = [(r.k, r.near_v) for r in asof.nearest(left, right, ["k"], "at", "d", 3, ["v"]).collect()]
    assert sorted(got, key=repr) == sorted([("A", 1.0), ("A", 1.0), ("A", None), ("B", None), (None, None)], key=repr)


def test_index_pages_and_documents(spark):
    raw = spark.createDataFrame([('{"cik":"7","filings":{"files":[{"name":"p1","filingFrom":"2010-01-01","filingTo":"2012-01-01"},{"name":"p2","filingFrom":"2000-01-01","filingTo":"2001-01-01"}]}}',)], "json string")
    assert [(r.cik, r.page) for r in text.index_pages(raw, "2011-05-01", "2020-01-01").collect()] == [("0000000007", "p1")]
    page = spark.createDataFrame([("7", '{"accessionNumber":["a","b"],"filingDate":["2011-01-01","2011-02-01"],"form":["10-K","4"],"primaryDocument":["x","y"]}')], "cik string, json string")
    assert [(r.cik, r.accession, r.filed) for r in text.index_page_filings(page, ["10-K"]).collect()] == [("0000000007", "a", D("2011-01-01"))]


def test_class_names_and_conversions(spark):
    names = spark.createDataFrame([("x:NonvotingMember",), ("x:PreferredClassAMember",), ("x:CommonClassBMember",)], "m string")
    assert [r.c for r in names.select(reference_data.canonical_class(F.col("m"), {"Nonvoting": "C"}).alias("c")).collect()] == ["C", None, "B"]
    eps = spark.createDataFrame([("T", "A", False, True, 6.0), ("T", "B", True, True, 2.0)], "ticker string, share_class string, priced boolean, diluted boolean, value double")
    eps = eps.withColumns({"period_start": F.lit(1), "period_end": F.lit(2)})
    back = spark.createDataFrame([("T", "A", 9.0), ("T", "Z", 4.0)], "ticker string, share_class string, conversion double")
    assert {r.share_class: r.conversion for r in reference_data.class_conversions(eps, fallback=back).collect()} == {"A": 3.0, "Z": 4.0}


def test_manifest_is_checked(spark):
    state = spark.createDataFrame([("A", "ok"), ("B", "odd")], "ticker string, status string")
    with pytest.raises(ValueError, match="B"):
        incremental.check_manifest(state)


def test_appends_compare_types(spark, tmp_path):
    rows = spark.createDataFrame([("T", 1, 1.0)], "ticker string, date int, v double")
    files.append_rows(spark, rows, str(tmp_path / "x"), ["ticker", "date"])
    with pytest.raises(ValueError, match="columns differ"):
        files.append_rows(spark, rows.withColumn("v", F.col("v").cast("int")), str(tmp_path / "x"), ["ticker", "date"])
    files.append_log(rows, str(tmp_path / "log"))
    files.append_log(rows, str(tmp_path / "log"))
    assert spark.read.option("header", True).csv(str(tmp_path / "log")).count() == 2


def test_sector_files(spark, tmp_path):
    for name, sector in (("a", "Energy"), ("b", "Utilities")):
        (tmp_path / f"{name}.csv").write_text(f"ticker,sector,industry,note\n t ,{sector},x,\n")
    assert files.read_sectors(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv")).first().sector == "Utilities"


def test_first_filing_stream_appends(spark, tmp_path):
    rows = spark.createDataFrame([("T", 2020, D("2021-02-01")), ("T", 2020, D("2021-09-01")), ("T", 2021, D("2022-02-01"))], "ticker string, fiscal_year int, filed date")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = incremental.first_filings(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    out = stream.writeStream.format("memory").queryName("firsts").outputMode("append").trigger(availableNow=True).start()
    out.awaitTermination()
    assert spark.table("firsts").count() == 2


def test_quarter_layer_against_each_view(spark, monkeypatch):
    """The series of the quarter layer are those of ``snapshot`` and
    ``periods`` on each point of view, and no view is written out."""
    from asofra.functions import storage
    from asofra.operators import periods, quarter_kernel, quarterly, snapshot, splits, vintages
    from asofra.plans.adapter import table

    facts, cuts, companies = (table(spark, "/root/testdata/sf0.001", n) for n in ("facts", "splits", "companies"))
    days = facts.where("fiscal_qtr IN ('Q1', 'Q2', 'Q3')").groupBy("ticker", "fiscal_year", F.col("fiscal_qtr").alias("quarter")).agg(F.max("filed").alias("as_of"))
    made = []
    for module in (quarterly, quarter_kernel):
        if hasattr(module, "written"):
            monkeypatch.setattr(module, "written", lambda df, name: made.append(storage.written(df, name)) or made[-1])
    rows = {(r.ticker, r.filed_date, r.period_end): r for r in quarterly.quarter_layer(facts, cuts, companies, days).collect()}
    assert rows and max(t.count() for t in made) <= facts.count()

    keys = ["ticker", "as_of"]
    own = spark.createDataFrame([k for k in rows], "ticker long, as_of date, anchor date")
    spans = vintages.view_intervals(vintages.without_deprecated(facts)).join(own.select(*keys).distinct(), "ticker")
    view = storage.written(spans.where("known_from <= as_of AND (known_to IS NULL OR as_of < known_to)").drop("known_from", "known_to"), "view")
    wide = own.select(*keys, F.lit(None).cast("date").alias("anchor"), F.lit(None).cast("date").alias("c_period_end")).distinct()
    native = {(r.ticker, r.as_of): r for r in snapshot.quarter_features(view, cuts, keys, wide).collect()}
    sums = periods.ttm(periods.flow_quarters(view, "revenue", keys), own, keys)
    sums = {(r.ticker, r.as_of, r.anchor): r for r in sums.collect()}
    known = 0
    for (ticker, as_of, anchor), r in rows.items():
        want = {n: native[ticker, as_of][f"q_{n}"] for n in quarterly.NATIVE} | {"stub_revenue": sums[ticker, as_of, anchor].ttm, "q3m_revenue": sums[ticker, as_of, anchor].q3m}
        known += sum(x is not None for x in want.values())
        assert {n: r[n] for n in want} == {n: x if x is None else pytest.approx(x, rel=1e-9) for n, x in want.items()}
    assert known > 100
