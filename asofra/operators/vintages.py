"""Vintages of reported facts: dedup, as-of views, period labels, pivot."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ANNUAL_FORMS, DEPRECATED_TAGS, EXPECTED_DAYS, FORM_PRIORITY, LAST_RANK

#: A fiscal year counts as reported with so many different concepts.
LEAST_CONCEPTS = 5


def duration_rank() -> Column:
    """0 if the period is as long as its label says, or nothing says so."""
    days = F.datediff("period_end", "period_start")
    rank = F.lit(0)
    for label, (low, high) in EXPECTED_DAYS.items():
        rank = F.when((F.col("fiscal_qtr") == label) & ~days.between(low, high), 1).otherwise(rank)
    return F.coalesce(rank, F.lit(0))


def form_rank() -> Column:
    rank = F.lit(LAST_RANK)
    for form, priority in FORM_PRIORITY.items():
        rank = F.when(F.col("form") == form, priority).otherwise(rank)
    return rank


def ranked(facts: DataFrame) -> DataFrame:
    """Add the ranks that choose among vintages; an unknown tag is last."""
    out = facts.withColumns({"duration_rank": duration_rank(), "form_rank": form_rank()})
    rank = F.coalesce("tag_rank", F.lit(LAST_RANK)) if "tag_rank" in facts.columns else F.lit(LAST_RANK)
    return out.withColumn("tag_rank", rank)


def first_by(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key; ties beyond ``order`` are the caller's to
    exclude. A key's rows are one filing history, which bounds the window."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(place)).where("_rn = 1").drop("_rn")


def dedup_filings(facts: DataFrame) -> DataFrame:
    """One row per ticker, concept, period, label and accession."""
    return first_by(
        ranked(facts), ["ticker", "concept", "period_end", "fiscal_qtr", "accession"],
        F.col("duration_rank"), F.col("form_rank"), F.col("tag_rank"), F.col("tag").desc(), F.col("value").desc(),
    )


def as_of_view(facts: DataFrame, as_of: Column, keys: Iterable[str] = ("ticker",)) -> DataFrame:
    """What was known at ``as_of`` (a column or literal): one row per key,
    concept, period and label among rows filed by then. Of rows of one form
    class the later accession wins, so an amendment beats the original."""
    known = ranked(facts.where(F.col("filed") <= as_of))
    return first_by(
        known, [*keys, "concept", "period_end", "fiscal_qtr"],
        F.col("duration_rank"), F.col("form_rank"), F.col("accession").desc(), F.col("tag_rank"), F.col("tag").desc(), F.col("value").desc(),
    )


def view_intervals(facts: DataFrame) -> DataFrame:
    """All as-of views at once: each winner with the days [known_from,
    known_to) on which it wins; known_to is null while it still does. The view
    of a day d is ``known_from <= d AND (known_to IS NULL OR d < known_to)``."""
    key = ["ticker", "concept", "period_end", "fiscal_qtr"]
    best = F.struct(
        (-F.col("duration_rank")).alias("a"), (-F.col("form_rank")).alias("b"), F.col("accession").alias("c"),
        (-F.col("tag_rank")).alias("d"), "tag", "value", "form", "fiscal_year", "period_start", F.col("filed").alias("won_filed"),
    )
    so_far = Window.partitionBy(*key).orderBy("filed").rangeBetween(Window.unboundedPreceding, 0)
    by_day = Window.partitionBy(*key).orderBy("filed")
    running = (
        ranked(facts.where("filed IS NOT NULL")).withColumn("best", F.max(best).over(so_far))
        .select(*key, "filed", "best").distinct()
        .withColumn("_before", F.lag("best").over(by_day))
        .where(~F.col("best").eqNullSafe(F.col("_before")))
    )
    return running.select(
        *key, F.col("filed").alias("known_from"), F.lead("filed").over(by_day).alias("known_to"),
        *(F.col(f"best.{c}").alias(c) for c in ("value", "tag", "form", "fiscal_year", "period_start")),
        F.col("best.c").alias("accession"), F.col("best.won_filed").alias("filed"),
    )


def period_type() -> Column:
    """FY or Q1-Q4: the label, else by the period's length and end month."""
    days, label = F.datediff("period_end", "period_start"), F.col("fiscal_qtr")
    by_month = F.concat(F.lit("Q"), F.quarter("period_end").cast("string"))
    return F.when(label.isin(*EXPECTED_DAYS), label).when(days > 300, "FY").when(days.between(60, 120), by_month)


def latest_annual(view: DataFrame, keys: Iterable[str] = ("ticker",)) -> DataFrame:
    """The newest fiscal year with LEAST_CONCEPTS concepts, and the last
    filing date of its rows."""
    keys = list(keys)
    years = (
        view.where((F.col("fiscal_qtr") == "FY") & F.col("value").isNotNull()).groupBy(*keys, "fiscal_year")
        .agg(F.countDistinct("concept").alias("n_concepts"), F.max("filed").alias("filed"))
        .where(F.col("n_concepts") >= LEAST_CONCEPTS)
    )
    best = F.max(F.struct("fiscal_year", "filed", "n_concepts")).alias("best")
    return years.groupBy(*keys).agg(best).select(*keys, "best.*")


def original_filing(facts: DataFrame) -> DataFrame:
    """The first annual filing date of each fiscal year."""
    annual = facts.where(F.col("form").isin(*ANNUAL_FORMS) & (F.col("fiscal_qtr") == "FY"))
    return annual.groupBy("ticker", "fiscal_year").agg(F.min("filed").alias("filed"))


def pivot(view: DataFrame, concepts: list[str], keys: Iterable[str] = ("ticker",)) -> DataFrame:
    """One row per key, fiscal year and period type, one column per concept:
    of each concept the latest period, then the latest filing."""
    keys = list(keys)
    newest = F.max_by("value", F.struct("period_end", "filed", "accession", F.col("value").alias("_v")))
    return (
        view.where("fiscal_qtr IS NOT NULL AND fiscal_year IS NOT NULL")
        .groupBy(*keys, "fiscal_year", F.col("fiscal_qtr").alias("period_type"))
        .pivot("concept", concepts)
        .agg(newest)
    )


def by_period(view: DataFrame, concepts: list[str], keys: Iterable[str] = ("ticker",)) -> DataFrame:
    """Annual rows by the day the period ends, whatever year labels them."""
    rows = view.where((F.col("fiscal_qtr") == "FY") & F.col("value").isNotNull())
    newest = F.max_by("value", F.struct("fiscal_year", "filed", "accession", F.col("value").alias("_v")))
    return rows.groupBy(*keys, "period_end").pivot("concept", concepts).agg(newest)


def dense(columns: list[str], least: int = LEAST_CONCEPTS) -> Column:
    """At least so many of the columns are not null."""
    return F.size(F.array_compact(F.array(*(F.col(c) for c in columns)))) >= least


def without_deprecated(facts: DataFrame, deprecated: dict[str, list[str]] = DEPRECATED_TAGS) -> DataFrame:
    """Drop (concept, tag) pairs that are no longer mapped."""
    gone = F.lit(False)
    for concept, tags in deprecated.items():
        gone = gone | ((F.col("concept") == concept) & F.col("tag").isin(*tags))
    return facts.where(~F.coalesce(gone, F.lit(False)))
