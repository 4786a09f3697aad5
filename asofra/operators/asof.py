"""As-of, interval and nearest-date joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _along(key: str, days: DataFrame, rows: DataFrame, day: str, known: str, payload: list[str]) -> tuple[DataFrame, Window]:
    """Days and rows of a key on one time line, rows before days."""
    line = rows.select(key, F.col(known).alias("_day"), F.lit(0).alias("_o"), F.struct(*payload).alias("_row"), F.lit(None).alias("_d")).where(
        F.col("_day").isNotNull()
    )
    kept = F.struct(*days.columns)
    asked = days.select(key, F.col(day).alias("_day"), F.lit(1).alias("_o"), F.lit(None).alias("_row"), kept.alias("_d"))
    order = Window.partitionBy(key).orderBy("_day", "_o").rowsBetween(Window.unboundedPreceding, 0)
    return line.unionByName(asked), order


def as_of_greatest(days: DataFrame, rows: DataFrame, key: str, day: str, known: str, payload: list[str]) -> DataFrame:
    """For each day the greatest row known by then, ``payload`` compared in
    order. With the period first, a late amendment of an old period does not
    displace a newer one. One shuffle and one running maximum, no range join.
    """
    line, order = _along(key, days, rows, day, known, payload)
    out = line.withColumn("_best", F.max("_row").over(order)).where("_o = 1")
    return out.select("_d.*", *(F.col(f"_best.{c}").alias(c) for c in payload))


def as_of_last(days: DataFrame, rows: DataFrame, key: str, day: str, known: str, payload: list[str]) -> DataFrame:
    """For each day the row that became known last by then; of several on
    one day the greatest."""
    newest = rows.groupBy(key, known).agg(F.max(F.struct(*payload)).alias("_p")).select(key, known, "_p.*")
    line, order = _along(key, days, newest, day, known, payload)
    out = line.withColumn("_best", F.last("_row", ignorenulls=True).over(order)).where("_o = 1")
    return out.select("_d.*", *(F.col(f"_best.{c}").alias(c) for c in payload))


def as_of_fresh(days: DataFrame, prices: DataFrame, key: str, day: str, date: str, value: str, most_days: int = 10) -> DataFrame:
    """The value on or before each day, null beyond ``most_days`` days."""
    seen = prices.withColumn("_at", F.col(date)).select(key, date, "_at", value)
    out = as_of_last(days, seen, key, day, date, ["_at", value])
    fresh = F.datediff(day, "_at") <= most_days
    return out.withColumn(value, F.when(fresh, F.col(value))).withColumn("price_date", F.when(fresh, F.col("_at"))).drop("_at")


def members_at(members: DataFrame, day: Column) -> DataFrame:
    """Rows whose interval [date_added, date_removed) holds the day; a null
    bound is open."""
    added, removed = F.col("date_added"), F.col("date_removed")
    return members.where((added.isNull() | (added <= day)) & (removed.isNull() | (removed > day)))


def dimension_at(history: DataFrame, day: Column, key: str = "ticker") -> DataFrame:
    """The version of each key that is valid on the day, or else its first
    version, which is so extended back."""
    live = F.col("valid_from") <= day
    days = F.datediff("valid_from", F.lit("1970-01-01"))
    order = Window.partitionBy(key).orderBy(F.when(live, 0).otherwise(1), F.when(live, -days).otherwise(days))
    return history.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def merge_dimension(history: DataFrame, fresh: DataFrame, as_of: Column, compared: list[str], key: str = "ticker") -> DataFrame:
    """Append new and changed rows of ``fresh`` as versions valid from
    ``as_of``. A version of that very day is replaced, older ones stay."""
    current = dimension_at(history.where(F.col("valid_from") < as_of), as_of, key)
    old = current.select(key, *(F.col(c).alias(f"_{c}") for c in compared), F.lit(True).alias("_seen"))
    changed = F.col("_seen").isNull()
    for c in compared:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    new = fresh.join(old, key, "left").where(changed).select(*fresh.columns).withColumn("valid_from", as_of)
    touched = fresh.select(key).distinct().withColumn("_fresh", F.lit(True))
    kept = history.join(touched, key, "left").where(~(F.col("_fresh").isNotNull() & (F.col("valid_from") == as_of))).drop("_fresh")
    return kept.unionByName(new, allowMissingColumns=True)


def nearest(left: DataFrame, right: DataFrame, keys: list[str], at: str, date: str, tolerance: int, payload: list[str]) -> DataFrame:
    """Each row of ``left`` with the row of ``right`` nearest to the day
    ``at``, within ``tolerance`` days; of two equally near the earlier, of
    several on one day the least ``payload``. A null key or day finds none.

    Both sides share a key's time line: the last row before and the first
    after a day are running picks in two directions, so the work is a shuffle
    and two sorts, whatever the number of rows of a key.
    """
    own = left.columns
    named = F.struct(F.col(date).alias("_date"), *(F.col(c).alias(f"p{k}") for k, c in enumerate(payload)))
    known = right.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, date]))
    days = known.groupBy(*keys, F.col(date).alias("_day")).agg(F.min(named).alias("_row"))
    asked = left.select(*keys, F.col(at).alias("_day"), F.lit(1).alias("_o"), F.lit(None).alias("_row"), F.struct(*own).alias("_d"))
    line = days.select(*keys, "_day", F.lit(0).alias("_o"), "_row", F.lit(None).alias("_d")).unionByName(asked)

    def pick(*order: Column) -> Column:
        by = Window.partitionBy(*keys).orderBy(*order, "_o").rowsBetween(Window.unboundedPreceding, 0)
        return F.last("_row", ignorenulls=True).over(by)

    met = line.withColumns({"_b": pick(F.col("_day").asc_nulls_first()), "_a": pick(F.col("_day").desc_nulls_last())}).where("_o = 1")
    before, after = F.datediff("_day", "_b._date"), F.datediff("_a._date", "_day")
    nearer = F.coalesce(before <= after, before.isNotNull())
    found = F.when(nearer & (before <= tolerance), F.col("_b")).when(~nearer & (after <= tolerance), F.col("_a"))
    return met.withColumn("_n", found).select("_d.*", *(F.col(f"_n.p{k}").alias(f"near_{c}") for k, c in enumerate(payload)))


def lagged(rows: DataFrame, keys: list[str], date: str, days: Column | int, tolerance: int, payload: list[str]) -> DataFrame:
    """Each row with the row of the same keys nearest to ``days`` earlier."""
    shift = days if isinstance(days, Column) else F.lit(days)
    asked = rows.withColumn("_at", F.date_sub(F.col(date), shift.cast("int")))
    return nearest(asked, rows, keys, "_at", date, tolerance, payload).drop("_at")
