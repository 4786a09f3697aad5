"""Domain operators on small hand-made inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from asofra import api, constants
from asofra.functions import kernel
from asofra.operators import asof, cross_section, daily, indicators, periods, reference_data, snapshot, splits, validate, vintages
from asofra.sources import files, text
from asofra.streaming import incremental

D = dt.date.fromisoformat
FACTS = "ticker string, concept string, tag string, tag_rank int, value double, period_end date, period_start date, filed date, form string, accession string, fiscal_year int, fiscal_qtr string"


def fact(concept, value, end, filed, start=None, form="10-K", accession="A1", year=2023, label="FY", tag=None, rank=0, ticker="T"):
    return (ticker, concept, tag or concept, rank, float(value), D(end), D(start) if start else None, D(filed) if filed else None, form, accession, year, label)


@pytest.fixture(scope="module")
def vintage_rows(spark):
    rows = [
        fact("revenue", 1_000_000, "2023-12-31", "2024-02-15", "2023-01-01", "10-K", "0001-24-000001", tag="Revenues"),
        fact("revenue", 1_010_000, "2023-12-31", "2024-05-01", "2023-01-01", "10-K/A", "0001-24-000099", tag="Revenues"),
        fact("revenue", 1_000_000, "2023-12-31", "2024-02-15", "2023-01-01", "10-K", "0001-24-000001", tag="SalesRevenueNet", rank=2),
        fact("total_assets", 5_000_000, "2023-12-31", "2024-02-15", None, "10-K", "0001-24-000001"),
        fact("cash", 1, "2023-12-31", None),
    ]
    return spark.createDataFrame(rows, FACTS)


def test_vintages(vintage_rows):
    kept = vintages.dedup_filings(vintage_rows).where("concept = 'revenue'").collect()
    assert sorted((r.accession, r.tag) for r in kept) == [("0001-24-000001", "Revenues"), ("0001-24-000099", "Revenues")]
    at = lambda day: {r.concept: r.value for r in vintages.as_of_view(vintage_rows, F.lit(day).cast("date")).collect()}
    assert at("2024-06-01")["revenue"] == 1_010_000
    assert at("2024-03-01") == {"revenue": 1_000_000, "total_assets": 5_000_000}
    assert at("2023-06-30") == {}
    spans = vintages.view_intervals(vintage_rows).where("concept = 'revenue'").orderBy("known_from").collect()
    assert [(r.value, r.known_to) for r in spans] == [(1_000_000, D("2024-05-01")), (1_010_000, None)]


def test_period_labels(spark):
    rows = [fact("x", 1, "2024-03-31", "2024-05-01", s, label=q) for s, q in (("2024-01-01", "Q1"), ("2023-04-02", None), ("2024-01-01", None), ("2023-10-01", None), (None, None))]
    got = [r.p for r in spark.createDataFrame(rows, FACTS).select(vintages.period_type().alias("p")).collect()]
    assert got == ["Q1", "FY", "Q1", None, None]
    days = spark.createDataFrame([(d,) for d in (90, 112, 181, 272, 363, 140, None)], "d int")
    assert [r.k for r in days.select(periods.duration_class(F.col("d")).alias("k")).collect()] == ["3mo", "3mo", "2Q", "3Q", "FY", None, None]


def test_quarters_from_cumulative_periods(spark):
    ends = ["2024-03-31", "2024-06-30", "2024-09-30", "2024-12-31"]
    rows = [fact("revenue", v, e, f, "2024-01-01") for v, e, f in zip((100, 220, 360, 520), ends, ("2024-05-01", "2024-08-01", "2024-11-01", "2025-02-15"))]
    got = periods.flow_quarters(spark.createDataFrame(rows, FACTS), "revenue", ["ticker"]).orderBy("qend").collect()
    assert [r.value for r in got] == [100, 120, 140, 160]
    rows.append(fact("revenue", 119, "2024-06-30", "2024-08-01", "2024-04-01"))
    mixed = periods.flow_quarters(spark.createDataFrame(rows, FACTS), "revenue", ["ticker"]).orderBy("qend").collect()
    assert [r.value for r in mixed] == [100, 119, 140, 160]
    total = periods.ttm(spark.createDataFrame([("T", D(e), 1.0 * v) for e, v in zip(ends, (1, 2, 3, 4))], "ticker string, qend date, value double"), spark.createDataFrame([("T", D(ends[3])), ("T", D(ends[2]))], "ticker string, anchor date"), ["ticker"])
    assert {r.anchor: (r.ttm, r.q3m) for r in total.collect()} == {D(ends[3]): (10, 4), D(ends[2]): (None, 3)}


def eps_rows(scale=1.0):
    year1 = [("2022-01-01", e, v * scale, f, form) for e, v, f, form in (("2022-04-01", 1.0, "2022-05-01", "10-Q"), ("2022-07-01", 2.0, "2022-08-01", "10-Q"), ("2022-10-01", 3.0, "2022-11-01", "10-Q"), ("2022-12-31", 4.0, "2023-02-15", "10-K"))]
    year2 = [("2023-01-01", e, v, f, form) for e, v, f, form in (("2023-04-01", 1.2, "2023-05-01", "10-Q"), ("2023-07-01", 2.4, "2023-08-01", "10-Q"), ("2023-10-01", 3.6, "2023-11-01", "10-Q"), ("2023-12-31", 5.0, "2024-02-15", "10-K"))]
    return [fact("eps_diluted", v, e, f, s, form) for s, e, v, f, form in year1 + year2]


@pytest.mark.parametrize("scale,cuts", [(1.0, []), (50.0, [("T", D("2023-03-01"), 0.02)])])
def test_ttm_eps(spark, scale, cuts):
    rows = spark.createDataFrame(eps_rows(scale), FACTS)
    table = splits.split_table(spark.createDataFrame(cuts, "ticker string, ex_date date, ratio double"))
    based = rows.join(table, "ticker", "left").withColumn("value", F.col("value") * splits.factor_after(F.col("splits"), F.col("filed")))
    series = periods.ttm_eps(based, ["ticker"])
    got = {str(r.qend): round(r.eps_ttm, 9) for r in series.collect()}
    assert got == {"2022-12-31": 4.0, "2023-04-01": 4.2, "2023-07-01": 4.4, "2023-10-01": 4.6, "2023-12-31": 5.0}
    days = spark.createDataFrame([("T", D(d)) for d in ("2023-01-01", "2023-03-01", "2023-05-15", "2023-12-15", "2024-03-01")], "ticker string, day date")
    known = series.withColumn("known", F.col("filed"))
    out = asof.as_of_greatest(days, known, "ticker", "day", "known", ["qend", "eps_ttm"]).orderBy("day").collect()
    assert [r.eps_ttm and round(r.eps_ttm, 9) for r in out] == [None, 4.0, 4.2, 4.6, 5.0]


def test_late_amendment_does_not_displace_a_newer_year(spark):
    fund = spark.createDataFrame([("T", 2021, D("2022-02-20")), ("T", 2022, D("2024-07-20")), ("T", 2023, D("2024-02-15"))], "ticker string, fiscal_year int, filed date")
    days = spark.createDataFrame([("T", D(d)) for d in ("2023-01-15", "2024-03-01", "2024-08-01")], "ticker string, day date")
    out = asof.as_of_greatest(days, fund, "ticker", "day", "filed", ["fiscal_year"]).orderBy("day").collect()
    assert [r.fiscal_year for r in out] == [2021, 2023, 2023]


def test_stale_price(spark):
    prices = spark.createDataFrame([("T", D("2024-01-05"), 10.0)], "ticker string, date date, close double")
    days = spark.createDataFrame([("T", D(d)) for d in ("2024-01-04", "2024-01-15", "2024-01-16")], "ticker string, day date")
    out = asof.as_of_fresh(days, prices, "ticker", "day", "date", "close").orderBy("day").collect()
    assert [r.close for r in out] == [None, 10.0, None]


def test_dimension(spark):
    history = spark.createDataFrame([("AAA", "Technology", D("2010-01-01")), ("AAA", "Communication Services", D("2020-06-01")), ("BBB", "Financial", D("2010-01-01")), ("CCC", "Energy", D("2024-03-01"))], "ticker string, sector string, valid_from date")
    at = lambda day: {r.ticker: r.sector for r in asof.dimension_at(history, F.lit(day).cast("date")).collect()}
    assert at("2015-06-30") == {"AAA": "Technology", "BBB": "Financial", "CCC": "Energy"}
    assert at("2020-06-01")["AAA"] == "Communication Services"
    fresh = spark.createDataFrame([("AAA", "Communication Services"), ("BBB", "Energy"), ("DDD", "Utilities")], "ticker string, sector string")
    day = F.lit("2025-01-01").cast("date")
    once = asof.merge_dimension(history, fresh, day, ["sector"])
    assert once.count() == 6
    again = asof.merge_dimension(once, fresh, day, ["sector"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_membership(spark):
    rows = [("AAPL", None, None), ("MSFT", None, None), ("REMOVED", D("2005-01-01"), D("2018-06-30")), ("OLDTK", None, D("2015-03-01")), ("NEWTK", D("2020-06-15"), None)]
    roster = spark.createDataFrame(rows, "ticker string, date_added date, date_removed date")
    at = lambda day: {r.ticker for r in asof.members_at(roster, F.lit(day).cast("date")).collect()}
    assert at("2023-01-01") == {"AAPL", "MSFT", "NEWTK"} and "REMOVED" in at("2017-01-01") and "REMOVED" not in at("2018-06-30")


def test_splits(spark):
    factors = spark.createDataFrame([(x,) for x in (1.0, 2.0, 1.065, 0.5, 1.5, 20.0, None, -2.0, 1.0001, 0.1)], "x double")
    got = [r.s for r in factors.select(splits.is_true_split(F.col("x")).alias("s")).collect()]
    assert got == [False, True, False, True, True, True, False, False, False, True]
    cuts = spark.createDataFrame([("T", D("2020-06-15"), 0.5), ("T", D("2021-01-01"), 0.25), ("T", None, 0.1), ("T", D("2022-01-01"), -1.0)], "ticker string, ex_date date, ratio double")
    days = spark.createDataFrame([("T", D(d)) for d in ("2020-06-14", "2020-06-15", "2021-06-01")] + [("U", D("2020-01-01")), ("T", None)], "ticker string, date date")
    assert {(r.ticker, str(r.date)): r.factor for r in splits.with_factor(days, cuts, "date").collect()} == {
        ("T", "2020-06-14"): 0.125, ("T", "2020-06-15"): 0.25, ("T", "2021-06-01"): 1.0, ("U", "2020-01-01"): 1.0, ("T", "None"): 1.0}


def test_guards(spark):
    one = spark.range(1)
    sql = {
        "a": kernel.div("1e0", "0e0"), "b": kernel.div("1e0", "CAST(NULL AS DOUBLE)"), "c": kernel.div("1e0", "0.005e0", "0.01"), "d": kernel.grow("1e0", "-2e0"),
        "e": kernel.flag("CAST(NULL AS DOUBLE) > 1"), "f": kernel.available("CAST(NULL AS DOUBLE)", "2e0"), "g": kernel.available("CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"),
    }
    row = one.select(*(F.expr(v).alias(k) for k, v in sql.items())).first()
    assert row.asDict() == {"a": None, "b": None, "c": None, "d": 1.5, "e": None, "f": 2.0, "g": None}
    null = F.lit(None).cast("double")
    row = one.select(kernel.clip(null, -1.0, 1.0).alias("a"), kernel.clip(F.lit(9.0), -1.0, 1.0).alias("b"), kernel.log_safe(F.lit(-1.0)).alias("c"), kernel.guarded(F.lit(1.0), F.lit(0.0)).alias("d"), kernel.no_nan(F.lit(float("nan"))).alias("e")).first()
    assert (row.a, row.b, round(row.c, 6), row.d, row.e) == (None, 1.0, -0.693147, None, None)


def test_price_sensitive(spark):
    values = dict(shares=1e9, eps=6.0, equity=50e9, revenue=400e9, fcf=100e9, ebitda=130e9, total_debt=120e9, net_debt=70e9, dividends=-15e9, buybacks=-80e9)
    stubs = {s: values.get(s) for s in constants.STUBS}
    row = spark.createDataFrame([(150.0, 0.12, *stubs.values())], "price double, eps_growth_yoy double, " + ", ".join(f"stub_{s} double" for s in stubs))
    got = row.select(*(F.expr(e).alias(n) for n, e in indicators.price_sensitive().items())).first().asDict()
    want = dict(market_cap=150e9, enterprise_value=220e9, pe_trailing=25, peg=25 / 12, pb=3, ps=0.375, pfcf=1.5, ev_ebitda=220 / 130, ev_revenue=0.55, earnings_yield=0.04, dividend_yield=0.1)
    assert all(got[k] == pytest.approx(v) for k, v in want.items())
    assert set(got) == set(constants.PRICE_SENSITIVE)


def annual(year, filed, ticker="T", **values):
    return [fact(c, v, f"{year}-12-31", filed, None if c in ("total_assets", "stockholders_equity", "cash", "shares_outstanding") else f"{year}-01-01", "10-K", f"A{year}", year, ticker=ticker, tag="EntityCommonStockSharesOutstanding" if c == "shares_outstanding" else c) for c, v in values.items()]


def company(spark):
    base = dict(revenue=350e9, cogs=200e9, operating_income=90e9, net_income=80e9, total_assets=300e9, stockholders_equity=100e9, long_term_debt=40e9, cash=20e9, operating_cashflow=95e9, eps_diluted=5.0, shares_outstanding=16e9)
    rows = []
    for year in range(2018, 2024):
        grown = 1.1 ** (year - 2018)
        rows += annual(year, f"{year + 1}-02-15", **{k: v * grown for k, v in base.items()})
    return spark.createDataFrame(rows, FACTS)


def test_indicators_of_a_company(spark):
    facts = company(spark)
    prices = spark.createDataFrame([("T", D("2024-02-14"), 50.0)], "ticker string, date date, close double")
    cuts = spark.createDataFrame([("T", D("2024-08-01"), 0.5)], "ticker string, ex_date date, ratio double")
    companies = spark.createDataFrame([("T", "Financial", "Banks")], "ticker string, sector string, industry string")
    dates = spark.createDataFrame([(D("2024-03-31"),), (D("2023-03-31"),)], "as_of date")
    rows = {str(r.as_of): r.asDict() for r in snapshot.assemble(facts, prices, cuts, companies, dates).collect()}
    got = rows["2024-03-31"]
    assert got["fiscal_year"] == 2023 and rows["2023-03-31"]["fiscal_year"] == 2022 and rows["2023-03-31"]["market_cap"] is None
    g = 1.1**5
    assert got["market_cap"] == pytest.approx(100 * 16e9 * g) and got["pe_trailing"] == pytest.approx(100 / (5 * g))
    assert got["revenue_growth_yoy"] == pytest.approx(0.1) and got["roe"] == pytest.approx(0.8) and got["gross_margin"] == pytest.approx(150 / 350)
    assert got["share_iss_1y"] == pytest.approx(0.1) and got["share_iss_5y"] == pytest.approx(g - 1)
    assert got["composite_debt_issuance"] == pytest.approx(5 * 0.0953101798) and got["f_roa"] == 1 and got["f_score"] is None
    assert got["gpa"] is None and got["z_score"] is None  # masked in the sector
    assert set(constants.INDICATORS) <= set(got)


def test_daily_layer_is_consistent_across_a_split(spark):
    days = [D("2020-06-01") + dt.timedelta(k) for k in range(40) if (D("2020-06-01") + dt.timedelta(k)).weekday() < 5]
    prices = spark.createDataFrame([("S", d, 50.0) for d in days], "ticker string, date date, close double")
    cuts = spark.createDataFrame([("S", D("2020-06-15"), 0.5)], "ticker string, ex_date date, ratio double")
    stubs = {s: None for s in constants.STUBS} | {"shares": 1e9, "eps": 5.0}
    schema = "ticker string, fiscal_year int, filed_date date, period_end date, eps_growth_yoy double, roe double, " + ", ".join(f"stub_{s} double" for s in stubs)
    fund = spark.createDataFrame([("S", 2019, D("2020-02-15"), D("2019-12-31"), None, 0.2, *stubs.values())], schema)
    shares = "ticker string, filed_date date, period_end date, shares double"
    counts = spark.createDataFrame([("S", D("2020-02-15"), D("2019-12-31"), 1e9), ("S", D("2020-06-25"), D("2020-06-20"), 2.05e9)], shares)
    out = {r.date: r for r in daily.daily_layer(prices, fund, counts, cuts, ["roe"]).collect()}
    before, after, later = out[D("2020-06-12")], out[D("2020-06-15")], out[D("2020-06-25")]
    assert (before.price, after.price) == (100, 50)
    assert before.market_cap == after.market_cap == pytest.approx(100e9) and later.market_cap == pytest.approx(50 * 2.05e9)
    assert before.pe_trailing == after.pe_trailing == pytest.approx(20) and later.roe == 0.2
    stale = spark.createDataFrame([("S", D("2019-05-01"), D("2019-03-31"), 7e8)], shares)
    row = daily.daily_layer(prices, fund, stale, cuts, ["roe"]).where("date = DATE '2020-06-12'").first()
    assert row.market_cap == pytest.approx(100e9)


def test_fund_layer(spark):
    companies = spark.createDataFrame([("T", "Technology", "Chips")], "ticker string, sector string, industry string")
    none = spark.createDataFrame([], "ticker string, ex_date date, ratio double")
    fund = daily.fund_layer(company(spark), none, companies).orderBy("fiscal_year").collect()
    assert [r.fiscal_year for r in fund] == list(range(2018, 2024))
    assert fund[-1].stub_shares == pytest.approx(16e9 * 1.1**5) and fund[0].revenue_growth_yoy is None and fund[1].revenue_growth_yoy == pytest.approx(0.1)


def test_streak_and_surprise(spark):
    ends = [D("2019-03-31"), D("2019-06-30"), D("2019-09-30"), D("2019-12-31"), D("2020-03-31"), D("2020-06-30"), D("2020-09-30"), D("2020-12-31")]
    series = lambda values: spark.createDataFrame([("T", e, float(v)) for e, v in zip(ends, values)], "ticker string, qend date, value double")
    streak = lambda values: periods.increase_streak(series(values), ["ticker"]).first().streak
    assert streak([1, 1, 1, 1, 0, 2, 2, 2]) == 3 and streak([1, 1, 1, 1, 2, 2, 2, 0]) == 0 and streak([1] * 4 + [2] * 4) == 0
    assert periods.seasonal_surprise(series([1, 1, 1, 1, 2, 3, 5, 9]), ["ticker"], 1e-10).first().surprise is not None
    assert periods.seasonal_surprise(series([1, 1, 1, 1, 2, 2, 2, 2]), ["ticker"], 1e-10).first().surprise is None


def test_robust_scores(spark):
    rows = [(g, v) for g, vs in (("a", [1.0, 2.0, 3.0, 4.0, 100.0, None]), ("flat", [2.0] * 5), ("few", [1.0, 2.0])) for v in vs]
    out = cross_section.robust_scores(spark.createDataFrame(rows, "g string, value double"), ["g"]).collect()
    z = {(r.g, r.value): r.z for r in out}
    assert z[("a", 3.0)] == 0 and z[("a", 100.0)] == 5 and z[("a", None)] is None
    assert z[("flat", 2.0)] is None and z[("few", 1.0)] is None


def test_rolling_scores_look_back_only(spark):
    values = [float(k % 7) for k in range(60)]
    frame = lambda vs: spark.createDataFrame([("T", k, v) for k, v in enumerate(vs)], "ticker string, date int, value double")
    score = lambda vs: [r.z for r in cross_section.rolling_scores(frame(vs), ["ticker"], "date", "value", 20, 10).orderBy("date").collect()]
    base = score(values)
    assert base[:50] == score([*values[:50], *[1000.0] * 10])[:50]
    assert all(z is None for z in base[:9]) and base[9] is not None and max(abs(z) for z in base[9:]) <= 3
    assert score([5.0] * 60) == [None] * 60


def test_group_operators(spark):
    rows = spark.createDataFrame([("d", "A", 1.0, 10.0), ("d", "A", 3.0, 10.0), ("d", "A", 5.0, None), ("d", "Unknown", 7.0, 1.0)], "date string, sector string, x double, y double")
    assert sorted(r.x for r in cross_section.demeaned(rows, "x", ["date", "sector"]).collect() if r.x is not None) == [-2.0, 0.0, 2.0]
    flags = [(r.sector, r.x) for r in cross_section.against_median(rows, {"x": True}, ["date", "sector"]).collect()]
    assert sorted(f for s, f in flags if s == "A") == [0, 0, 1] and ("Unknown", None) in flags
    assert cross_section.herfindahl(rows, "x", ["date", "sector"]).first().herf == pytest.approx(35 / 81)
    assert cross_section.group_growth(rows, "y", "x", ["date", "sector"]).first().growth == pytest.approx(4.0)


def test_classes(spark):
    members = spark.createDataFrame([("us-gaap:CommonClassAMember",), ("x:SeriesBPreferredStock",), ("Other",), ("co:ClassBShares",)], "m string")
    assert [r.c for r in members.select(reference_data.canonical_class(F.col("m")).alias("c")).collect()] == ["A", None, "Other", "B"]
    day = D("2024-04-15")
    counts = spark.createDataFrame([("T", "ACC-1", day, "A", False, 1000.0), ("T", "ACC-1", day, "B", True, 50000.0)], "ticker string, accession string, period_end date, share_class string, priced boolean, value double")
    eps = spark.createDataFrame([("T", D("2024-01-01"), D("2024-03-31"), "A", False, 4500.0), ("T", D("2024-01-01"), D("2024-03-31"), "B", True, 3.0)], "ticker string, period_start date, period_end date, share_class string, priced boolean, value double")
    assert reference_data.class_shares(counts, reference_data.class_conversions(eps)).first().shares == 1_550_000
    assert reference_data.class_shares(counts, reference_data.class_conversions(eps.limit(0))).first().shares is None


def test_company_json(spark):
    doc = '{"cik": 320193, "entityName": "X", "facts": {"us-gaap": {"Revenues": {"units": {"USD": [{"start": "2023-01-01", "end": "2023-12-31", "val": 5.5, "accn": "a", "fy": 2023, "fp": "FY", "form": "10-K", "filed": "2024-02-01"}]}}, "Other": {"units": {"USD": []}}}, "srt": {"Revenues": {"units": {}}}}}'
    tags = spark.createDataFrame([(t, c, k) for c, ts in constants.CONCEPT_TAGS.items() for k, t in enumerate(ts)], "tag string, concept string, tag_rank int")
    row = text.company_facts(spark.createDataFrame([(doc,), ("not json",), (None,)], "json string"), tags).collect()
    assert [(r.cik, r.concept, r.value, str(r.filed), r.fiscal_qtr) for r in row] == [("0000320193", "revenue", 5.5, "2024-02-01", "FY")]


def test_text_parsers(spark):
    df = spark.createDataFrame([('<a class="x" href="s?f=sec_tech">Tech &amp; <span>more</span></a><a href="s?f=ind_chips">Chips</a>',)], "h string")
    row = df.select(text.linked_label(F.col("h"), "sec").alias("s"), text.linked_label(F.col("h"), "ind").alias("i"), text.linked_label(F.col("h"), "geo").alias("g")).first()
    assert tuple(row) == ("Tech & more", "Chips", None)


def test_overrides_and_sectors(spark):
    schema = "ticker string, sector string, industry string"
    scraped = spark.createDataFrame([("A", "Energy", "x"), ("B", "Utilities", "x")], schema)
    back = spark.createDataFrame([("B", "Financial", "y"), ("C", "Energy", "y")], schema)
    over = spark.createDataFrame([("A", "Technology", "z"), ("D", "Healthcare", "z")], schema)
    got = {r.ticker: (r.sector, r.source) for r in reference_data.layered_sectors(scraped, back, over).collect()}
    assert got == {"A": ("Technology", "override"), "B": ("Utilities", "scraped"), "C": ("Energy", "fallback"), "D": ("Healthcare", "override")}
    assert reference_data.with_overrides(scraped, over, "ticker", ["sector", "industry"]).count() == 3
    with pytest.raises(Exception, match="unknown sector"):
        reference_data.check_sectors(spark.createDataFrame([("A", "Nope")], "ticker string, sector string")).collect()


def test_files(spark, tmp_path):
    path = tmp_path / "roster.csv"
    path.write_text("row,ticker,name,cik,occurrence,date_added,date_removed,a,b\n1, aapl , Apple ,320193,1,,2020-01-01,,\n")
    row = files.read_roster(spark, str(path), least_rows=0).first()
    assert (row.ticker, row.name, row.date_removed) == ("AAPL", "Apple", D("2020-01-01"))
    with pytest.raises(ValueError):
        files.read_roster(spark, str(path))
    rows = spark.createDataFrame([("T", 1, 1.0), ("T", 2, 2.0)], "ticker string, date int, v double")
    layer = str(tmp_path / "layer")
    assert [files.append_rows(spark, rows, layer, ["ticker", "date"]) for _ in range(2)] == [2, 0]
    with pytest.raises(ValueError):
        files.append_rows(spark, rows.drop("v"), layer, ["ticker", "date"])


def test_api(spark, vintage_rows, tmp_path):
    with pytest.raises(ValueError):
        api.get_fundamentals(vintage_rows, "T")
    assert api.get_fundamentals(vintage_rows, "T", "2024-03-01").count() == 2
    assert api.get_fundamentals(vintage_rows, "T", vintages_=True).count() == 5
    assert constants.indicator_names(["VALUATION"])[0] == "pe_trailing" and len(constants.indicator_names()) == 130
    with pytest.raises(ValueError):
        constants.indicator_names(["nope"])
    root = str(tmp_path)
    company(spark).write.parquet(f"{root}/facts")
    days = [D("2024-03-01") + dt.timedelta(k) for k in range(20)]
    price = spark.createDataFrame([("T", d, 50.0) for d in days], "ticker string, date date, close double")
    price.where("date < DATE '2024-03-15'").write.parquet(f"{root}/prices")
    spark.createDataFrame([("T", D("2019-01-01"), 0.5)], "ticker string, ex_date date, ratio double").write.parquet(f"{root}/splits")
    spark.createDataFrame([("T", "Technology", "Chips")], "ticker string, sector string, industry string").write.parquet(f"{root}/companies")
    api.build_timeseries(spark, root)
    assert api.load_ticker_timeseries(spark, root, "T").count() == 14
    price.where("date >= DATE '2024-03-15'").write.mode("append").parquet(f"{root}/prices")
    assert [api.run_incremental_update(spark, root) for _ in range(2)] == [6, 0]
    assert api.load_ticker_timeseries(spark, root, "T", "2024-03-10", "2024-03-16").count() == 7
    assert api.load_daily_cross_section(spark, root, "2024-03-05").first().sector == "Technology"
    assert api.list_timeseries_tickers(spark, root).count() == 1


def test_update_plan(spark):
    assert incremental.due_tiers(D("2024-05-02"), D("2024-04-30"), D("2024-04-30")) == ["M", "D"]
    assert incremental.due_tiers(D("2024-05-09"), D("2024-05-02"), D("2024-05-02")) == ["W", "D"]
    assert incremental.due_tiers(D("2024-05-02"), None, None) == ["M", "W", "D"]
    state = spark.createDataFrame([("A", "ok", "0", D("2024-01-05")), ("B", "ok", "0", D("2024-01-05")), ("C", "removed", "0", None)], "ticker string, status string, splits_hash string, last_daily_date date")
    cuts = spark.createDataFrame([("B", D("2024-01-08"), 0.5)], "ticker string, ex_date date, ratio double")
    plan = incremental.plan_updates(state, cuts)
    assert {r.ticker: r.action for r in plan.collect()} == {"A": "append", "B": "rebuild"}
    days = spark.createDataFrame([(t, D("2024-01-01") + dt.timedelta(k), 1.0) for t in "ABC" for k in range(10)], "ticker string, date date, v double")
    assert {r.ticker: r["count"] for r in incremental.fresh_rows(days, plan).groupBy("ticker").count().collect()} == {"A": 5, "B": 10}


def test_streams(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([("T", k, dt.datetime(2024, 1, 1, k), 1.0) for k in range(6)], "ticker string, date int, ts timestamp, v double")
    rows.where("date < 3").write.parquet(source)

    def apply(batch, _):
        files.append_rows(spark, batch, out, ["ticker", "date"])

    for _ in range(2):
        incremental.stream_layer(spark, source, rows.schema, apply, str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(out).count() in (3, 6)
        rows.where("date >= 3").write.mode("append").parquet(source)
    assert spark.read.parquet(out).count() == 6
    stream = spark.readStream.schema(rows.schema).parquet(source)
    windowed = incremental.windowed(stream, "ts", "v", "ticker", "2 hours").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    windowed.awaitTermination()
    assert sorted(r.n for r in spark.table("w").collect())[-1] in (2, 4)


def test_reports(spark):
    rows = spark.createDataFrame([("A", 1.0, None), ("A", 2.0, 1.0), ("B", None, 1.0)], "sector string, x double, y double")
    got = {(r.sector, r.name): (r.percent, r.tier) for r in validate.coverage(rows, ["x", "y"], "sector").collect()}
    assert got[("A", "x")] == (100, "high") and got[("A", "y")] == (50, "medium") and got[("B", "x")] == (0, "low")
    left = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    right = spark.createDataFrame([(1, 1.0), (3, 3.0)], "k int, v double")
    assert sorted((r.k, r.left_value, r.right_value) for r in validate.difference(left, right, ["k"], ["v"]).collect()) == [(2, 2.0, None), (3, None, 3.0)]


def test_finalize(spark):
    names = ["ticker", "as_of", "sector", "industry", *constants.INDICATORS, "ing_rev_lag1", "ing_rev_lag2"]
    rows = []
    for k in range(5):
        values = {n: 1.0 * k for n in constants.INDICATORS} | {"ms_score": None, "ms_accrual": 1.0, "revenue_raw": 10.0 * k, "ww_index": 0.0}
        rows.append((f"T{k}", D("2024-01-01"), "Utilities" if k == 4 else "Energy", "Oil", *(values[n] for n in constants.INDICATORS), 8.0 * k, 4.0 * k))
    schema = "ticker string, as_of date, sector string, industry string, " + ", ".join(f"{n} double" for n in names[4:])
    got = {r.ticker: r for r in snapshot.finalize(spark.createDataFrame(rows, schema)).collect()}
    assert [got[f"T{k}"].ch_inv_ia for k in range(4)] == [-1.5, -0.5, 0.5, 1.5]
    assert (got["T3"].ms_roa, got["T3"].ms_roa_vol, got["T3"].ms_score, got["T0"].ms_score) == (1, 0, 6, 3)
    assert got["T0"].herf == pytest.approx(30 / 100) and got["T4"].herf is None and got["T4"].ms_roa is None
    assert got["T1"].ww_index == pytest.approx(0.102 * 0.25 / 4) and "ing_rev_lag1" not in got["T1"].asDict()


def test_quarter_layer(spark):
    rows = []
    for year in (2022, 2023):
        for q, end in enumerate(("03-31", "06-30", "09-30", "12-31"), 1):
            filed = f"{year}-{3 * q + 1:02d}-20" if q < 4 else f"{year + 1}-02-20"
            label, form, acc = (f"Q{q}", "10-Q", f"{year}{q}") if q < 4 else ("FY", "10-K", f"{year}4")
            flow = lambda c, v: rows.append(fact(c, v, f"{year}-{end}", filed, f"{year}-01-01", form, acc, year, label))  # noqa: B023, E731
            for concept, value in (("revenue", 100.0 * q), ("net_income", 10.0 * q), ("operating_cashflow", 20.0 * q), ("capex", 5.0 * q), ("cogs", 60.0 * q), ("eps_diluted", 1.0 * q)):
                flow(concept, value)
            for concept in ("total_assets", "stockholders_equity", "cash"):
                rows.append(fact(concept, 400.0, f"{year}-{end}", filed, None, form, acc, year, label))
    from asofra.operators import quarterly

    companies = spark.createDataFrame([("T", "Energy", "Oil")], "ticker string, sector string, industry string")
    none = spark.createDataFrame([], "ticker string, ex_date date, ratio double")
    got = {(r.fiscal_year, r.quarter): r for r in quarterly.quarter_layer(spark.createDataFrame(rows, FACTS), none, companies).collect()}
    assert len(got) == 6 and got[(2022, "Q2")].roe is None and got[(2022, "Q2")].q3m_revenue == 100
    row = got[(2023, "Q2")]
    assert (row.roe, row.gross_margin, row.stub_revenue, row.stub_fcf, row.stub_eps) == (0.1, 0.4, 400, 60, 4)
    assert row.roaq == pytest.approx(10 / 400) and row.q3m_net_income == 10 and row.filed_date == D("2023-07-20")


def test_instance_document(spark):
    from asofra.sources import xbrl

    context = '<context id="{0}"><entity><segment>{1}</segment></entity><period><instant>2024-04-15</instant></period></context>'
    member = '<explicitMember dimension="{0}">{1}</explicitMember>'
    xml = '<x xmlns:dei="d">' + context.format("a", member.format("us-gaap:StatementClassOfStockAxis", "co:ClassAMember")) + context.format("b", member.format("other:Axis", "z"))
    xml += context.format("c", "") + "".join(f'<dei:EntityCommonStockSharesOutstanding contextRef="{c}">{v}</dei:EntityCommonStockSharesOutstanding>' for c, v in (("a", 5), ("b", 6), ("c", 7), ("c", "n/a"))) + "</x>"
    docs = spark.createDataFrame([("A1", "10-Q", D("2024-05-01"), xml), ("A2", "10-Q", None, "no xml"), ("A3", None, None, None)], "accession string, form string, filed date, xml string")
    got = [(r.member, r.value, str(r.period_end), r.form) for r in xbrl.instance_facts(docs).collect()]
    assert sorted(got) == [("", 7.0, "2024-04-15", "10-Q"), ("co:ClassAMember", 5.0, "2024-04-15", "10-Q")]
