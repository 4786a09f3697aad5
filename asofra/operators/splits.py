"""Share splits: factors, windows, true-split test, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A price factor nearer to one than this is no split.
LEAST_RATIO = 1.15
CLOSE = 0.002
MOST_DENOMINATOR = 10


def split_table(splits: DataFrame, key: str = "ticker") -> DataFrame:
    """One row per key with its splits as an array; a company has few."""
    good = splits.where((F.col("ratio") > 0) & F.col("ex_date").isNotNull())
    return good.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ex_date", "ratio"))).alias("splits"))


def _product(kept: Column) -> Column:
    return F.aggregate(kept, F.lit(1.0), lambda a, s: a * s["ratio"])


def factor_after(splits: Column, day: Column) -> Column:
    """Product of the ratios after the day; one for a null day or no split."""
    after = _product(F.filter(splits, lambda s: s["ex_date"] > day))
    return F.when(splits.isNull() | day.isNull(), 1.0).otherwise(after)


def factor_between(splits: Column, start: Column, end: Column) -> Column:
    """Product of the ratios in (start, end]."""
    inside = _product(F.filter(splits, lambda s: (s["ex_date"] > start) & (s["ex_date"] <= end)))
    return F.when(splits.isNull() | start.isNull() | end.isNull(), 1.0).otherwise(inside)


def with_factor(rows: DataFrame, splits: DataFrame, day: str, name: str = "factor", key: str = "ticker") -> DataFrame:
    joined = rows.join(split_table(splits, key), key, "left")
    return joined.withColumn(name, factor_after(F.col("splits"), F.col(day))).drop("splits")


def as_traded(prices: DataFrame, splits: DataFrame) -> DataFrame:
    """Undo the split adjustment: the price as it was traded that day."""
    return with_factor(prices, splits, "date").withColumn("price", F.col("close") / F.col("factor"))


def is_true_split(x: Column) -> Column:
    """Whether a factor is a small fraction p/q, q up to MOST_DENOMINATOR,
    within CLOSE of it, and far enough from one. False for null."""
    far = (x > 0) & (F.abs(F.log(x)) >= F.log(F.lit(LEAST_RATIO)))

    def fits(q: Column) -> Column:
        p = F.rint(x * q)
        return (p >= 1) & (p != q) & (F.abs(x * q / p - 1) <= CLOSE)

    return F.coalesce(far & F.exists(F.sequence(F.lit(1), F.lit(MOST_DENOMINATOR)), fits), F.lit(False))


def fingerprints(splits: DataFrame, key: str = "ticker") -> DataFrame:
    """``date:ratio`` of each split in order, joined by semicolons; a ratio
    has eight significant digits and no zeros behind the last."""
    text = F.regexp_replace(F.format_string("%.15f", F.expr("round(ratio * power(10, 7 - floor(log10(ratio)))) / power(10, 7 - floor(log10(ratio)))")), r"\.?0+$", "")
    each = F.concat_ws(":", F.col("ex_date").cast("string"), text)
    listed = F.array_sort(F.collect_list(F.struct("ex_date", each.alias("text"))))
    return splits.groupBy(key).agg(listed.alias("_l")).select(key, F.concat_ws(";", F.col("_l.text")).alias("splits_hash"))
