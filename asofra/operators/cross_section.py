"""Cross-section operators: group adjustments, robust scores, screens."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import LOG_TRANSFORMED, SECTOR_MASKS, UNKNOWN_SECTOR
from ..functions.kernel import clip, guarded, log_safe

MAD_SCALE = 1.4826
TINY = 1e-12


def masked_columns(rows: DataFrame, sector: str = "sector") -> DataFrame:
    """Null what has no meaning in a row's sector."""
    out = {}
    for name, column in ((n, F.col(n)) for names in SECTOR_MASKS.values() for n in names if n in rows.columns):
        sectors = [s for s, names in SECTOR_MASKS.items() if name in names]
        out[name] = F.when(~F.coalesce(F.col(sector).isin(*sectors), F.lit(False)), column)
    return rows.withColumns(out) if out else rows


def known_group(group: str) -> Column:
    return F.col(group).isNotNull() & (F.col(group) != UNKNOWN_SECTOR)


def demeaned(rows: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """Less the group's mean; null in an unknown group. The means are one
    small row per group, joined back."""
    means = rows.where(known_group(groups[-1])).groupBy(*groups).agg(F.avg(value).alias("_mean"))
    return rows.join(means, groups, "left").withColumn(value, F.col(value) - F.col("_mean")).drop("_mean")


def against_median(rows: DataFrame, values: dict[str, bool], groups: list[str], least: int = 3) -> DataFrame:
    """1 above (True) or below (False) the group's median, else 0; null with
    fewer than ``least`` values in the group."""
    agg = rows.where(known_group(groups[-1])).groupBy(*groups).agg(
        *(F.percentile(v, 0.5).alias(f"_m_{v}") for v in values), *(F.count(v).alias(f"_n_{v}") for v in values)
    )
    joined = rows.join(agg, groups, "left")
    out = {}
    for v, above in values.items():
        beats = F.col(v) > F.col(f"_m_{v}") if above else F.col(v) < F.col(f"_m_{v}")
        out[v] = F.when(F.col(f"_n_{v}") >= least, beats.cast("double"))
    return joined.withColumns(out).drop(*(f"_{k}_{v}" for v in values for k in "mn"))


def herfindahl(rows: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """(groups, herf, n): the sum of squared shares of positive values."""
    agg = rows.where((F.col(value) > 0) & known_group(groups[-1])).groupBy(*groups).agg(
        F.sum(F.col(value) * F.col(value)).alias("_q"), F.sum(value).alias("_s"), F.count("*").alias("n")
    )
    return agg.select(*groups, (F.col("_q") / (F.col("_s") * F.col("_s"))).alias("herf"), "n")


def group_growth(rows: DataFrame, now: str, before: str, groups: list[str]) -> DataFrame:
    """(groups, growth) of the sums over rows that have both values."""
    both = rows.where(F.col(now).isNotNull() & F.col(before).isNotNull() & known_group(groups[-1]))
    agg = both.groupBy(*groups).agg(F.sum(now).alias("_a"), F.sum(before).alias("_b"))
    return agg.select(*groups, guarded(F.col("_a") - F.col("_b"), F.abs("_b")).alias("growth"))


def melt(rows: DataFrame, ids: list[str], values: Iterable[str]) -> DataFrame:
    return rows.unpivot(ids, list(values), "name", "value")


def robust_scores(long: DataFrame, groups: list[str], value: str = "value", least: int = 3, bound: float = 5.0, calibration: DataFrame | None = None) -> DataFrame:
    """Add z: winsorised at the 2.5 and 97.5 percentiles of its group, less
    the median, by the scaled median deviation, within +-bound. Null below
    ``least`` values or without spread.

    ``calibration`` (groups, _med, _mad, _m) takes the place of the group's
    own median, median deviation and count. Each stage joins one small row
    per group back.
    """
    clipped = _winsorised(long, groups, value)
    if calibration is None:
        middle = clipped.groupBy(*groups).agg(F.percentile("_w", 0.5).alias("_med"), F.count("_w").alias("_m"))
        far = F.percentile(F.abs(F.col("_w") - F.col("_med")), 0.5).alias("_mad")
        spread = clipped.select(*groups, "_w").join(middle, groups).groupBy(*groups).agg(far)
        joined = clipped.join(middle, groups, "left").join(spread, groups, "left")
    else:
        joined = clipped.join(calibration, groups, "left")
    scale = F.lit(MAD_SCALE) * F.col("_mad")
    good = (F.col("_n") >= least) & (F.col("_m") >= least) & (scale >= TINY)
    z = clip((F.col("_w") - F.col("_med")) / scale, -bound, bound)
    return joined.withColumn("z", F.when(good, z)).drop("_n", "_w", "_med", "_m", "_mad")


def _winsorised(long: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Add _w, the value within its group's percentiles, and _n."""
    ends = long.groupBy(*groups).agg(
        F.percentile(value, F.array(F.lit(0.025), F.lit(0.975))).alias("_q"), F.count(value).alias("_n")
    )
    return long.join(ends, groups, "left").withColumn("_w", clip(F.col(value), F.col("_q")[0], F.col("_q")[1])).drop("_q")


def pooled_statistics(long: DataFrame, snapshot: str, groups: list[str], value: str = "value", least: int = 3) -> DataFrame:
    """(snapshot, groups, _med, _mad, _m) of the values of each snapshot and
    all before it, each snapshot winsorised by its own percentiles and skipped
    below ``least`` values.

    A group (an indicator) is one task's: its values merge snapshot by
    snapshot into one sorted array, from which each statistic is read. Values
    move once, none is copied to later snapshots. The array has eight bytes a
    value; a group is bounded by companies times snapshots.
    """
    own = [snapshot, *groups]
    clipped = _winsorised(long.select(*own, value), own, value)
    usable = F.when(F.col("_n") >= least, F.col("_w")).alias("_w")
    schema = long.select(*own).schema.add("_med", "double").add("_mad", "double").add("_m", "long")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(snapshot)
        times = table[snapshot].combine_chunks()
        starts = np.flatnonzero(np.concatenate(([True], pc.not_equal(times[1:], times[:-1]).to_numpy(zero_copy_only=False))))
        values = table["_w"].to_numpy()
        pool, found = np.zeros(0), []
        for a, b in zip(starts, np.append(starts[1:], len(times))):
            new = np.sort(values[a:b][~np.isnan(values[a:b])])
            pool = np.insert(pool, np.searchsorted(pool, new), new)
            middle = float(np.median(pool)) if pool.size else None
            found.append((middle, float(np.median(np.abs(pool - middle))) if pool.size else None, pool.size))
        rows = table.select(own).take(pa.array(starts))
        for name, column, kind in zip(("_med", "_mad", "_m"), zip(*found), (pa.float64(), pa.float64(), pa.int64())):
            rows = rows.append_column(name, pa.array(column, kind))
        return rows

    return clipped.where(F.col(snapshot).isNotNull()).select(*own, usable).groupBy(*groups).applyInArrow(run, schema)


def expanding_scores(long: DataFrame, snapshot: str, groups: list[str], value: str = "value") -> DataFrame:
    pooled = pooled_statistics(long, snapshot, groups, value)
    return robust_scores(long, [snapshot, *groups], value, calibration=pooled)


def sector_scores(long: DataFrame, groups: list[str], value: str = "value", least: int = 5, bound: float = 3.0) -> DataFrame:
    """Add z within the group: limited to median +- 3 scaled median
    deviations, then by mean and deviation, within +-bound."""
    middle = long.groupBy(*groups).agg(F.percentile(value, 0.5).alias("_med"), F.count(value).alias("_n"))
    far = long.join(middle, groups, "left")
    spread = far.groupBy(*groups).agg((F.lit(MAD_SCALE) * F.percentile(F.abs(F.col(value) - F.col("_med")), 0.5)).alias("_mad"))
    joined = far.join(spread, groups, "left")
    limit = 3 * F.col("_mad")
    limited = F.when((F.col("_n") < 3) | (F.col("_mad") < TINY), F.col(value)).otherwise(
        clip(F.col(value), F.col("_med") - limit, F.col("_med") + limit)
    )
    joined = joined.withColumn("_w", limited)
    moments = joined.groupBy(*groups).agg(F.avg("_w").alias("_mean"), F.stddev_samp("_w").alias("_sd"))
    scored = joined.join(moments, groups, "left")
    good = (F.col("_n") >= least) & (F.col("_sd") >= TINY)
    z = clip((F.col("_w") - F.col("_mean")) / F.col("_sd"), -bound, bound)
    return scored.withColumn("z", F.when(good, z)).drop("_med", "_n", "_mad", "_w", "_mean", "_sd")


def log_levels(rows: DataFrame) -> DataFrame:
    """Sign-keeping logarithms of the size indicators that ``rows`` has."""
    return rows.withColumns({c: log_safe(F.col(c)) for c in LOG_TRANSFORMED if c in rows.columns})


def medians(rows: DataFrame, values: list[str], groups: list[str], date: str, key: str, least: int = 10) -> DataFrame:
    """(groups, medians) of dates with ``least`` companies at least."""
    enough = rows.groupBy(date).agg(F.countDistinct(key).alias("_n")).where(F.col("_n") >= least).select(date)
    return rows.join(enough, date, "left_semi").groupBy(*groups).agg(*(F.percentile(v, 0.5).alias(v) for v in values))


#: Of the mean square about a key's mean; a frame's variance below is none.
ROUNDING = 1e-11


def rolling_scores(rows: DataFrame, keys: list[str], date: str, value: str, window: int = 1260, least: int = 252, bound: float = 3.0) -> DataFrame:
    """Add z by trailing rows only: limited to mean +- 3 deviations of the
    last ``window`` rows, then by the moments of such values. Null for a null
    value, below ``least`` values in the frame, or without spread.

    Moments come from running sums and those ``window`` rows before, so a row
    costs the same whatever the window. Sums are taken about the key's first
    value, which keeps them small.
    """
    order = Window.partitionBy(*keys).orderBy(date)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)

    def with_moments(frame: DataFrame, c: str) -> DataFrame:
        x = F.col(c) - F.col("_origin")
        sums = {"_s0": F.count(x).over(so_far), "_s1": F.coalesce(F.sum(x).over(so_far), F.lit(0.0)), "_s2": F.coalesce(F.sum(x * x).over(so_far), F.lit(0.0))}
        frame = frame.withColumns(sums)
        frame = frame.withColumns({f"_d{k}": F.col(f"_s{k}") - F.coalesce(F.lag(f"_s{k}", window).over(order), F.lit(0)) for k in range(3)})
        n, s1, s2 = F.col("_d0"), F.col("_d1"), F.col("_d2")
        square = s2 - s1 * s1 / n
        spread = F.when(n == 1, 0.0).when((n > 1) & (square > ROUNDING * F.col("_s2")), F.sqrt(square / (n - 1))).when(n > 1, 0.0)
        return frame.withColumns({"_mean": F.when(n > 0, F.col("_origin") + s1 / n), "_sd": spread, "_n": n}).drop(*(f"_{p}{k}" for p in "sd" for k in range(3)))

    out = with_moments(rows.withColumn("_origin", F.first(value, ignorenulls=True).over(order)), value)
    limited = F.when(F.col("_sd") > 0, clip(F.col(value), F.col("_mean") - 3 * F.col("_sd"), F.col("_mean") + 3 * F.col("_sd"))).otherwise(F.col(value))
    out = with_moments(out.withColumn("_w", limited), "_w")
    good = F.col(value).isNotNull() & (F.col("_n") >= least) & (F.col("_sd") >= TINY)
    z = clip((F.col("_w") - F.col("_mean")) / F.col("_sd"), -bound, bound)
    return out.withColumn("z", F.when(good, z)).drop("_mean", "_sd", "_n", "_w", "_origin")


def top(rows: DataFrame, by: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows with the greatest values; each task keeps its own n."""
    return rows.orderBy(F.col(by).desc(), *ties).limit(n)


def above_quantile(rows: DataFrame, value: str, q: float, groups: list[str]) -> DataFrame:
    """The rows at or above their group's quantile."""
    cut = rows.groupBy(*groups).agg(F.percentile(value, q).alias("_cut"))
    return rows.join(cut, groups).where(F.col(value) >= F.col("_cut")).drop("_cut")


def profile(rows: DataFrame, values: list[str], groups: list[str]) -> DataFrame:
    """(groups, medians, n): what is usual in each group."""
    return rows.groupBy(*groups).agg(*(F.percentile(v, 0.5).alias(v) for v in values), F.count("*").alias("n"))


def last_rows(rows: DataFrame, keys: list[str], date: str, n: int) -> DataFrame:
    """The last ``n`` rows of each key by date."""
    order = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    return rows.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")
