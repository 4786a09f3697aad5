"""The quarter layer's time series in arrays: many points of view at once.

A point of view is a ticker and a day. Facts come as the intervals on which
they win (``vintages.view_intervals``); a fact's views are then a range of the
sorted points of view, so the views exist only as two integer arrays of one
bucket of tickers and are never written or shuffled. Each step does what the
function of ``periods`` or ``snapshot`` that it names does on DataFrames.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..constants import DURATIONS, SHARES_TAGS
from . import splits
from .periods import ANCHOR_TOLERANCE, LAG_DAYS, LAG_TOLERANCE, LAGS, QUARTER_DAYS, YEAR_DAYS, YEAR_TOLERANCE

#: Codes put days into fields of so many numbers, day zero in the middle.
FIELD, ZERO = 1 << 24, 1 << 23
#: A day that is null; it sorts before all others.
NO_DAY = -(1 << 22)
FAR = 1 << 40
#: Intervals a bucket, about; a ticker stays whole.
BUCKET = 50_000
FEATURES = "net net_at rev rev_before tax tax_before tax_at streak eps_surprise revenue_surprise fcf_stability".split()
DAYS = "period_end period_start filed known_from known_to".split()


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True at each row that differs from the one before in some column."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The values at the places, NaN at place -1."""
    return np.append(values, np.nan)[at]


class Series:
    """Values by base (an integer) and day, sorted, one a day."""

    def __init__(self, base: np.ndarray, day: np.ndarray, value: np.ndarray, *order: np.ndarray):
        """Of several on one day, the first by ``order``, then value."""
        code = base * FIELD + day + ZERO
        by = np.lexsort((value, *reversed(order), code))
        by = by[_changes(code[by])]
        self.code, self.base, self.day, self.value = code[by], base[by], day[by], value[by]
        self.known = np.ones(len(by), bool)
        self.ends = np.append(self.code, FAR * FIELD)

    def like(self, value: np.ndarray, known: np.ndarray) -> Series:
        """Other values on the same days, of which some may be null."""
        out = object.__new__(Series)
        out.__dict__ = self.__dict__ | {"value": value, "known": known}
        return out

    def nearest(self, base: np.ndarray, day: np.ndarray, tolerance: int, asked: np.ndarray | bool = True) -> np.ndarray:
        """``asof.nearest``: the place of the row, or -1."""
        at, n = base * FIELD + day + ZERO, len(self.code)
        i, j = np.searchsorted(self.code, at, "right") - 1, np.searchsorted(self.code, at, "left")
        before = np.where((i >= 0) & (self.ends[i] >= base * FIELD), at - self.ends[i], FAR)
        after = np.where((j < n) & (self.ends[j] < (base + 1) * FIELD), self.ends[j] - at, FAR)
        return np.where(asked & (np.minimum(before, after) <= tolerance), np.where(before <= after, i, j), -1)

    def last(self, base: np.ndarray) -> np.ndarray:
        """The place of the base's last row, or -1."""
        at = np.searchsorted(self.code, (base + 1) * FIELD, "left") - 1
        return np.where((at >= 0) & (self.ends[at] >= base * FIELD), at, -1)

    def knows(self, at: np.ndarray) -> np.ndarray:
        return np.append(self.known, False)[at]

    def lags(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``periods.with_lags`` of some rows: values and whether known."""
        at = np.stack([self.nearest(self.base[places], self.day[places] - round(m * LAG_DAYS), LAG_TOLERANCE) for m in range(1, LAGS + 1)], 1)
        return _take(self.value, at), self.knows(at)

    def change(self) -> Series:
        """``periods.seasonal_change``."""
        at = self.nearest(self.base, self.day - YEAR_DAYS, YEAR_TOLERANCE)
        return self.like(self.value - _take(self.value, at), self.known & self.knows(at))


class Views:
    """The facts of a bucket and the points of view on them."""

    def __init__(self, facts: pa.Table, own: pa.Table):
        tickers = pc.unique(own["ticker"])
        mine = pc.index_in(own["ticker"], value_set=tickers).to_numpy().astype(np.int64)
        day = own["as_of"].cast(pa.int32()).to_numpy().astype(np.int64)
        self.keys, self.key_of_own = np.unique(mine * FIELD + day + ZERO, return_inverse=True)
        facts = facts.append_column("_t", pc.index_in(facts["ticker"], value_set=tickers))
        facts = facts.filter(pc.is_valid(facts["_t"])).drop_columns(["ticker"])
        for name in facts.column_names:
            kind = np.float64 if name == "value" else bool if name in ("other", "given") else np.int64
            setattr(self, name, facts[name].to_numpy().astype(kind))
        self.ticker = self._t
        self.lo = np.searchsorted(self.keys, self.ticker * FIELD + self.known_from + ZERO, "left")
        self.hi = np.searchsorted(self.keys, self.ticker * FIELD + self.known_to + ZERO, "left")

    def first(self, rows: np.ndarray, *group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``rows`` are facts sorted by the columns ``group``, then by what is
        preferred: (point of view, fact) of the first in each group and view,
        by view, then in the order of ``rows``."""
        lo, count = self.lo[rows], np.maximum(self.hi[rows] - self.lo[rows], 0)
        place = np.repeat(np.arange(len(rows)), count)
        key = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count) + lo[place]
        code = np.sort(key * max(len(rows), 1) + place)
        key, place = code // max(len(rows), 1), code % max(len(rows), 1)
        chosen = _changes(key, np.cumsum(_changes(*(g[rows] for g in group)))[place])
        return key[chosen], rows[place[chosen]]

    def preferred(self, where: np.ndarray, group: list[np.ndarray]) -> np.ndarray:
        """Facts by group, no 8-K if possible, filed first."""
        rows = np.flatnonzero(where)
        order = (self.value, self.period_end, self.filed, self.other, *reversed(group), self.ticker)
        return rows[np.lexsort([c[rows] for c in order])]


def _side(key: np.ndarray, row: np.ndarray, kind: np.ndarray, *group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One line per view and group: view, its first fact, and the facts of the
    four kinds, -1 where there is none."""
    new = _changes(key, *(g[row] for g in group))
    slots = np.full((int(new.sum()), 4), -1)
    slots[np.cumsum(new) - 1, kind[row]] = row
    return key[new], row[new], slots


def duration_kind(v: Views) -> np.ndarray:
    days, kind = v.period_end - v.period_start, np.full(len(v.ticker), -1)
    for k, (low, high) in enumerate(DURATIONS.values()):
        kind[(days >= low) & (days <= high)] = k
    kind[(v.period_end == NO_DAY) | (v.period_start == NO_DAY)] = -1
    return kind


def flow_quarters(v: Views, flows: int) -> Series:
    """``periods.flow_quarters`` of the concepts below ``flows``; the base is
    view times ``flows`` plus concept."""
    kind = duration_kind(v)
    group = [v.concept, v.period_start, kind]
    rows = v.preferred(v.given & (v.concept < flows) & (kind >= 0), group)
    key, row, slots = _side(*v.first(rows, v.ticker, *group), kind, v.concept, v.period_start)
    base = key * flows + v.concept[row]
    parts = []
    for high, low in ((0, None), (1, 0), (2, 1), (3, 2)):
        there = slots[:, high] >= 0 if low is None else (slots[:, high] >= 0) & (slots[:, low] >= 0)
        a = slots[there, high]
        if low is None:
            parts.append((base[there], v.period_end[a], np.zeros(len(a), int), v.filed[a], v.value[a]))
            continue
        b = slots[there, low]
        gap = v.period_end[a] - v.period_end[b]
        fits = (gap >= QUARTER_DAYS[0]) & (gap <= QUARTER_DAYS[1])
        a, b = a[fits], b[fits]
        parts.append((base[there][fits], v.period_end[a], np.ones(len(a), int), np.maximum(v.filed[a], v.filed[b]), v.value[a] - v.value[b]))
    base, day, derived, filed, value = map(np.concatenate, zip(*parts))
    return Series(base, day, value, derived, filed)


def only(s: Series, concept: int, flows: int) -> Series:
    """One concept of the flows, by view."""
    mine = s.base % flows == concept
    return Series(s.base[mine] // flows, s.day[mine], s.value[mine])


def instants(v: Views, concept: int) -> Series:
    rows = v.preferred(v.given & (v.concept == concept) & (v.period_end != NO_DAY), [v.period_end])
    key, row = v.first(rows, v.ticker, v.period_end)
    return Series(key, v.period_end[row], v.value[row])


def ttm(s: Series, base: np.ndarray, anchor: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """``periods.ttm``: (sum, whether known), (quarter, whether known)."""
    own = s.nearest(base, anchor, ANCHOR_TOLERANCE, anchor != NO_DAY)
    there, end = own >= 0, np.append(s.day, 0)[own]
    steps = [s.nearest(base, end - round(m * LAG_DAYS), LAG_TOLERANCE, there) for m in range(1, 4)]
    q3m = _take(s.value, own)
    before = sum(_take(s.value, k) for k in steps)
    return (q3m + before, there & np.logical_and.reduce([k >= 0 for k in steps])), (q3m, there)


def ttm_eps(v: Views, concept: int) -> Series:
    """``periods.ttm_eps``."""
    days = v.period_end - v.period_start
    kind = np.where(v.period_end == NO_DAY, 3, np.searchsorted([135, 225, 315], days, "left"))
    group = [v.period_start, kind]
    rows = v.preferred(v.given & (v.concept == concept) & (v.period_start != NO_DAY), group)
    key, _, slots = _side(*v.first(rows, v.ticker, *group), kind, v.period_start)
    before = np.full_like(slots, -1)
    before[1:] = np.where((key[1:] == key[:-1])[:, None], slots[:-1], -1)
    parts = []
    for k in range(4):
        there = slots[:, k] >= 0 if k == 3 else (slots[:, k] >= 0) & (before[:, k] >= 0) & (before[:, 3] >= 0)
        a = slots[there, k]
        value = v.value[a] if k == 3 else v.value[a] + v.value[before[there, 3]] - v.value[before[there, k]]
        dated = v.period_end[a] != NO_DAY
        parts.append((key[there][dated], v.period_end[a][dated], v.filed[a][dated], value[dated]))
    base, day, filed, value = map(np.concatenate, zip(*parts))
    return Series(base, day, value, filed)


def per_share(v: Views, rev: Series, concept: int) -> Series:
    """``snapshot.quarter_shares`` and the quarter's revenue on them."""
    rows = np.flatnonzero(v.given & (v.concept == concept) & (v.period_end != NO_DAY))
    rows = rows[np.lexsort([c[rows] for c in (v.value, v.filed, v.period_end, v.tag_place)])]
    place = np.zeros(len(v.ticker), int)
    place[rows] = np.arange(len(rows))
    by_label = rows[np.lexsort([c[rows] for c in (v.label, v.period_end, v.ticker)])]
    key, row = v.first(by_label, np.arange(len(v.ticker)))
    code = key * FIELD + v.period_end[row] + ZERO
    lo, hi = np.searchsorted(code, rev.code, "left"), np.searchsorted(code, rev.code + 75, "right")
    best = np.full(len(rev.code), -1)
    there = hi > lo
    if there.any():
        count = (hi - lo)[there]
        start = np.cumsum(count) - count
        each = np.arange(count.sum()) - np.repeat(start, count) + np.repeat(lo[there], count)
        best[there] = rows[np.minimum.reduceat(place[row[each]], start)]
    shares = _take(v.value, best)
    good = (best >= 0) & ~(shares <= 0)
    return rev.like(np.divide(rev.value, shares, out=np.full(len(shares), np.nan), where=good), good)


def streak(s: Series, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``periods.increase_streak``."""
    change, last = s.change(), s.last(keys)
    there = last >= 0
    lags, known = change.lags(last[there])
    values = np.column_stack([change.value[last[there]], lags])
    stops = np.column_stack([change.known[last[there]], known]) & (values <= 0)
    out = np.full(len(keys), np.nan)
    out[there] = np.argmax(stops, 1)
    return out, there


def surprise(s: Series, keys: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """``periods.seasonal_surprise``. Deviations are needed only on the days
    that the last quarter's lags reach."""
    change, last = s.change(), s.last(keys)
    there = last >= 0
    recent = np.flatnonzero(s.day >= np.append(s.day[last[there]], 0)[np.minimum(np.searchsorted(keys[there], s.base), there.sum())] - round(LAGS * LAG_DAYS) - LAG_TOLERANCE)
    lags, known = change.lags(recent)
    n = known.sum(1)
    drift = np.divide(np.where(known, lags, 0).sum(1), n, out=np.full(len(n), np.nan), where=n > 0)
    value, sure = np.full(len(s.code), np.nan), np.zeros(len(s.code), bool)
    value[recent], sure[recent] = change.value[recent] - drift, change.known[recent] & (n > 0)
    su = s.like(value, sure)
    lags, known = su.lags(last[there])
    n = known.sum(1)
    mean = np.divide(np.where(known, lags, 0).sum(1), n, out=np.zeros(len(n)), where=n > 0)
    spread = np.where(known, lags - mean[:, None], 0)
    sd = np.sqrt(np.divide((spread * spread).sum(1), n - 1, out=np.zeros(len(n)), where=n > 1))
    quarters = np.searchsorted(s.code, (keys[there] + 1) * FIELD, "left") - np.searchsorted(s.code, keys[there] * FIELD, "left")
    good = (quarters >= 4) & (n >= 2) & ~(sd <= floor) & sure[last[there]]
    out, fine = np.full(len(keys), np.nan), np.zeros(len(keys), bool)
    out[there] = np.divide(value[last[there]], sd, out=np.full(len(sd), np.nan), where=good)
    fine[there] = good
    return out, fine


def cash_flow_stability(v: Views, keys: np.ndarray, cfo: int, assets: int) -> tuple[np.ndarray, np.ndarray]:
    """``snapshot.cash_flow_stability``."""
    where = ((v.concept == cfo) | (v.concept == assets)) & (v.label > 0) & (v.fiscal_year != NO_DAY)
    rows = np.flatnonzero(where)
    rows = rows[np.lexsort([c[rows] for c in (-v.period_end, v.concept, v.label, v.fiscal_year, v.ticker)])]
    key, row = v.first(rows, v.ticker, v.fiscal_year, v.label, v.concept)
    new = _changes(key, v.fiscal_year[row])
    line = np.cumsum(new) - 1
    flow, sheet = np.full((int(new.sum()), 4), np.nan), np.full((int(new.sum()), 4), np.nan)
    known, held = np.zeros(flow.shape, bool), np.zeros(flow.shape, bool)
    kind = duration_kind(v)
    is_flow = v.concept[row] == cfo
    for mine, values, flags, extra in ((is_flow, flow, known, kind[row] == v.label[row] - 1), (~is_flow, sheet, held, True)):
        put = mine & v.given[row] & extra
        values[line[put], v.label[row[put]] - 1], flags[line[put], v.label[row[put]] - 1] = v.value[row[put]], True
    alone, sure = flow.copy(), known.copy()
    alone[:, 1:], sure[:, 1:] = flow[:, 1:] - flow[:, :-1], known[:, 1:] & known[:, :-1]
    good = sure & held & ~(sheet <= 0)
    ratio = alone[good] / sheet[good]
    owner = np.repeat(key[new], 4).reshape(-1, 4)[good]
    # lines are sorted by view and year, so the last sixteen are the newest
    end = np.searchsorted(owner, keys, "right")
    n = np.minimum(end - np.searchsorted(owner, keys, "left"), 16)
    newest = end[:, None] - 1 - np.arange(16)
    inside = np.arange(16) < n[:, None]
    x = np.where(inside, _take(ratio, np.where(inside, newest, -1)), 0)
    mean = x.sum(1) / np.maximum(n, 1)
    spread = np.where(inside, x - mean[:, None], 0)
    return np.sqrt((spread * spread).sum(1) / np.maximum(n - 1, 1)), n >= 8


def _latest(s: Series, sheet: Series, keys: np.ndarray, days: int, tolerance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The last quarter, the one ``days`` before, and the latter's assets."""
    last = s.last(keys)
    end = np.append(s.day, 0)
    back = s.nearest(keys, end[last] - days, tolerance, last >= 0)
    at = sheet.nearest(keys, end[back], ANCHOR_TOLERANCE, back >= 0)
    return [(_take(x.value, k), k >= 0) for x, k in ((s, last), (s, back), (sheet, at))]


def _rows(facts: pa.Table, own: pa.Table, flows: list[str], schema: pa.Schema) -> pa.Table:
    if not own.num_rows:
        return schema.empty_table()
    v, count = Views(facts, own), len(flows) + 1
    eps, assets, shares = len(flows), len(flows) + 1, len(flows) + 2
    series, sheet = flow_quarters(v, count), instants(v, assets)
    key, keys = v.key_of_own, np.arange(len(v.keys))
    anchor = own["period_end"].cast(pa.int32()).fill_null(NO_DAY).to_numpy().astype(np.int64)
    made = {}
    for k, c in enumerate(flows):
        made[f"ttm_{c}"], made[f"q3m_{c}"] = ttm(series, key * count + k, anchor)
    told = ttm_eps(v, eps)
    near = told.nearest(key, anchor, ANCHOR_TOLERANCE, anchor != NO_DAY)
    summed, sure = ttm(series, key * count + eps, anchor)[0]
    made["_eps"] = np.where(near >= 0, _take(told.value, near), summed), (near >= 0) | sure
    net, rev, tax, per = (only(series, k, count) for k in (*map(flows.index, ("net_income", "revenue", "income_tax_expense")), eps))
    native = {}
    native["net"], _, native["net_at"] = _latest(net, sheet, keys, 91, LAG_TOLERANCE)
    native["rev"], native["rev_before"], _ = _latest(rev, sheet, keys, 91, LAG_TOLERANCE)
    native["tax"], native["tax_before"], native["tax_at"] = _latest(tax, sheet, keys, YEAR_DAYS, YEAR_TOLERANCE)
    native["streak"] = streak(net, keys)
    native["eps_surprise"] = surprise(per, keys, 1e-10)
    native["revenue_surprise"] = surprise(per_share(v, rev, shares), keys, 1e-8)
    native["fcf_stability"] = cash_flow_stability(v, keys, flows.index("operating_cashflow"), assets)
    made |= {n: (native[n][0][key], native[n][1][key]) for n in FEATURES}
    columns = [own[n] for n in own.column_names]
    columns += [pa.array(x, pa.float64(), mask=~good) for x, good in (made[n] for n in schema.names[len(columns):])]
    return pa.table(columns, schema=schema)


def with_series(own: DataFrame, spans: DataFrame, split_table: DataFrame, flows: list[str]) -> DataFrame:
    """``own`` (ticker, as_of, period_end as the anchor, ...) with ttm_ and q3m_
    of each flow, _eps, and FEATURES, of the facts that ``spans`` has for that
    ticker and day. One shuffle of the intervals, by ticker."""
    wanted = [*flows, "eps_diluted", "total_assets", "shares_outstanding"]
    used = spans.where(F.col("concept").isin(wanted) & (F.col("known_to").isNull() | (F.col("known_from") < F.col("known_to"))))
    factor = splits.factor_after(F.col("splits"), F.col("filed"))
    value = F.when(F.col("concept") == "eps_diluted", F.col("value") * factor).when(
        F.col("concept") == "shares_outstanding", F.col("value") / factor).otherwise(F.col("value"))

    def code(column: str, names: list[str], other: int) -> Column:
        places = F.create_map(*(F.lit(x) for k, n in enumerate(names) for x in (n, k)))
        return F.coalesce(places[F.col(column)], F.lit(other))

    days = [F.coalesce(F.unix_date(c), F.lit(ZERO - 1 if c == "known_to" else NO_DAY)).alias(c) for c in DAYS]
    buckets = max(1, spans.count() // BUCKET)
    bucket = F.pmod(F.xxhash64("ticker"), F.lit(buckets)).alias("_bucket")
    based = used.join(splits.split_table(split_table), "ticker", "left").withColumn("value", value)
    facts = based.withColumns({"given": F.col("value").isNotNull(), "value": F.coalesce("value", F.lit(0.0))}).select(
        bucket, "ticker", *days, "value", "given", code("concept", wanted, -1).alias("concept"),
        (code("fiscal_qtr", ["Q1", "Q2", "Q3", "Q4"], -1) + 1).alias("label"), F.coalesce("fiscal_year", F.lit(NO_DAY)).alias("fiscal_year"),
        (F.coalesce(F.col("form"), F.lit("")) == "8-K").alias("other"), code("tag", SHARES_TAGS, len(SHARES_TAGS)).alias("tag_place"),
    )
    names = [*(f"{k}_{c}" for c in flows for k in ("ttm", "q3m")), "_eps", *FEATURES]
    schema = own.schema
    for n in names:
        schema = schema.add(n, "double")
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _rows(left.drop_columns(["_bucket"]), right.drop_columns(["_bucket"]), flows, arrow)

    return facts.groupBy("_bucket").cogroup(own.withColumn("_bucket", bucket).groupBy("_bucket")).applyInArrow(run, schema)
