"""Rosters, sectors and company text: the reference-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import SECTORS, UNKNOWN_SECTOR


def pad_cik(cik: Column) -> Column:
    return F.when(cik.isNotNull(), F.lpad(F.trim(cik.cast("string")), 10, "0"))


def resolve_ciks(roster: DataFrame, *sources: DataFrame) -> DataFrame:
    """Add cik from the first source (ticker, cik) that has the ticker; the
    sources are lookups of one row per ticker."""
    out = roster.drop("cik")
    found = []
    for k, source in enumerate(sources):
        out = out.join(source.select("ticker", pad_cik(F.col("cik")).alias(f"_cik{k}")), "ticker", "left")
        found.append(F.col(f"_cik{k}"))
    return out.withColumn("cik", F.coalesce(*found)).drop(*(f"_cik{k}" for k in range(len(sources))))


def with_overrides(base: DataFrame, overrides: DataFrame, key: str, columns: list[str], order: str | None = None) -> DataFrame:
    """Replace ``columns`` where ``overrides`` has the key, and add the keys
    that only it has. Of repeated overrides the one with the greatest
    ``order`` wins, or, without it, the one with the greatest columns."""
    last = F.max(F.struct(*([order] if order else []), *columns)).alias("_o")
    overrides = overrides.groupBy(key).agg(last).select(key, *(F.col(f"_o.{c}").alias(c) for c in columns))
    named = overrides.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    changed = base.join(named, key, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).drop(*(f"_{c}" for c in columns))
    missing = overrides.join(base.select(key), key, "left_anti").select(key, *columns)
    return changed.unionByName(missing, allowMissingColumns=True)


def check_sectors(rows: DataFrame) -> DataFrame:
    """Rows whose sector is one of the known strings; others raise."""
    wrong = F.raise_error(F.concat(F.lit("unknown sector: "), F.coalesce("sector", F.lit("null")))).cast("string")
    return rows.withColumn("sector", F.when(F.col("sector").isin(*SECTORS), F.col("sector")).otherwise(wrong))


def layered_sectors(scraped: DataFrame, fallback: DataFrame, overrides: DataFrame) -> DataFrame:
    """One row per ticker: the scraped sector, else the fallback, overrides
    first; ``source`` tells which."""
    parts = [t.select("ticker", "sector", "industry", F.lit(s).alias("source"), F.lit(k).alias("_o")) for k, (s, t) in enumerate((("override", overrides), ("scraped", scraped), ("fallback", fallback)))]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("sector IS NOT NULL")
    return both.withColumn("_rn", F.row_number().over(Window.partitionBy("ticker").orderBy("_o", "industry"))).where("_rn = 1").drop("_rn", "_o")


def attach_dimension(rows: DataFrame, dimension: DataFrame, key: str = "ticker", columns: tuple[str, ...] = ("sector", "industry")) -> DataFrame:
    """Left join; a missing label is UNKNOWN_SECTOR."""
    joined = rows.join(dimension.select(key, *columns), key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(UNKNOWN_SECTOR)) for c in columns})


def statuses(roster: DataFrame, successors: DataFrame, bankrupt: list[str], private: list[str]) -> DataFrame:
    """Add status and successor to removed members, in that order: renamed,
    bankrupt, taken private, acquired; members are active."""
    joined = roster.join(successors.select("ticker", "successor"), "ticker", "left")
    status = (
        F.when(F.col("date_removed").isNull(), "active").when(F.col("successor").isNotNull(), "change")
        .when(F.col("ticker").isin(*bankrupt), "bankrupt").when(F.col("ticker").isin(*private), "private").otherwise("acquired")
    )
    return joined.withColumn("status", status)


def duplicate_class(roster: DataFrame) -> DataFrame:
    """Add occurrences and duplicate_class: one row per ticker is unique, rows
    of one company are re-entries, rows of several are reused tickers."""
    by = Window.partitionBy("ticker")
    ciks = F.size(F.collect_set("cik").over(by))
    return roster.withColumn("occurrences", F.count("*").over(by)).withColumn(
        "duplicate_class", F.when(F.col("occurrences") == 1, "unique").when(ciks <= 1, "reentry").otherwise("reused")
    )


def newest_entity(facts: DataFrame) -> DataFrame:
    """Of several companies under one ticker the one that filed last."""
    return facts.groupBy("ticker").agg(F.max_by("cik", F.struct("filed", "cik")).alias("cik"))


def modal(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key; of equally frequent the least."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).count()
    by = Window.partitionBy(*keys).orderBy(F.col("count").desc(), F.col(value))
    return counts.withColumn("_rn", F.row_number().over(by)).where("_rn = 1").select(*keys, value, F.col("count").alias("n"))


def canonical_class(member: Column, member_map: dict[str, str] | None = None) -> Column:
    """``A`` from a member name like ``x:CommonClassAMember``. A name that a
    pattern of ``member_map`` fits is what that says, in its order; a
    preferred class is none; another name stands for itself."""
    local = F.regexp_replace(member, "^[^:]*:", "")
    letter = F.regexp_extract(local, "(Class|Series)([A-Z])(?![a-z])", 2)
    out = F.when(local.contains("Preferred"), F.lit(None).cast("string"))
    for pattern, name in (member_map or {}).items():
        out = out.when(local.rlike(pattern), name)
    return out.when(letter != "", letter).otherwise(local)


def class_conversions(eps: DataFrame, least: float = 0.05, fallback: DataFrame | None = None) -> DataFrame:
    """(ticker, share_class, conversion): the median over periods of a class's
    earnings per share over those of the priced class, where the latter is
    not too small. Where ``eps`` has a column diluted, basic earnings come
    first and diluted ones where a class has no basic ratio; last comes
    ``fallback`` (ticker, share_class, conversion)."""
    keys = ["ticker", "period_start", "period_end"]
    rows = eps if "diluted" in eps.columns else eps.withColumn("diluted", F.lit(False))
    other = rows.where("NOT priced").join(
        rows.where("priced").select(*keys, "diluted", F.col("value").alias("_priced")), [*keys, "diluted"]
    )
    ratio = other.where(F.abs("_priced") >= least).withColumn("_r", F.col("value") / F.col("_priced"))
    agg = ratio.groupBy("ticker", "share_class").agg(
        F.percentile(F.when(~F.col("diluted"), F.col("_r")), 0.5).alias("_basic"), F.percentile(F.when(F.col("diluted"), F.col("_r")), 0.5).alias("_diluted")
    )
    found = agg.select("ticker", "share_class", F.coalesce("_basic", "_diluted").alias("conversion"))
    if fallback is None:
        return found
    missing = fallback.select("ticker", "share_class", "conversion").join(found.where("conversion IS NOT NULL"), ["ticker", "share_class"], "left_anti")
    return found.where("conversion IS NOT NULL").unionByName(missing)


def class_shares(counts: DataFrame, conversions: DataFrame) -> DataFrame:
    """(ticker, accession, period_end, shares, n_classes): shares on the
    priced class's basis at the day with most classes of a filing; null if a
    class has no conversion."""
    days = counts.groupBy("ticker", "accession", "period_end").agg(F.countDistinct("share_class").alias("n_classes"))
    best = days.groupBy("ticker", "accession").agg(F.max(F.struct("n_classes", "period_end")).alias("_b")).select("ticker", "accession", "_b.*")
    own = counts.join(best, ["ticker", "accession", "period_end"]).join(conversions, ["ticker", "share_class"], "left")
    factor = F.when(F.col("priced"), 1.0).otherwise(F.col("conversion"))
    agg = own.groupBy("ticker", "accession", "period_end", "n_classes").agg(
        F.sum(F.col("value") * factor).alias("_s"), F.sum(F.when(factor.isNull(), 1).otherwise(0)).alias("_bad")
    )
    return agg.select("ticker", "accession", "period_end", F.when(F.col("_bad") == 0, F.col("_s")).alias("shares"), "n_classes")


def chosen_counts(cover: DataFrame, sheet: DataFrame) -> DataFrame:
    """Per ticker and accession the class counts of the cover page or of the
    balance sheet (both as for ``class_shares``): the one with more classes,
    the cover where they have as many; ``source`` tells which."""
    size = lambda rows, name: rows.groupBy("ticker", "accession").agg(F.countDistinct("share_class").alias(name))
    both = size(cover, "_c").join(size(sheet, "_s"), ["ticker", "accession"], "full_outer")
    better = F.coalesce(F.col("_c"), F.lit(0)) >= F.coalesce(F.col("_s"), F.lit(0))
    picked = both.select("ticker", "accession", F.when(better, "cover").otherwise("sheet").alias("source"))
    rows = cover.withColumn("source", F.lit("cover")).unionByName(sheet.withColumn("source", F.lit("sheet")))
    return rows.join(picked, ["ticker", "accession", "source"], "left_semi")


def class_earnings(eps: DataFrame) -> DataFrame:
    """(ticker, period_start, period_end, value, source): earnings per share
    of the priced class, the first there is of: basic and diluted in one,
    diluted, basic."""
    ladder = F.when(F.col("kind") == "both", 0).when(F.col("kind") == "diluted", 1).otherwise(2)
    best = F.min(F.struct(ladder.alias("rank"), F.col("value").alias("value"), F.col("kind").alias("source"))).alias("_b")
    rows = eps.where("priced AND value IS NOT NULL").groupBy("ticker", "period_start", "period_end").agg(best)
    return rows.select("ticker", "period_start", "period_end", "_b.value", "_b.source")


def merge_synthetic(organic: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Replace a concept's own rows by synthetic ones within the days these
    span; without synthetic rows nothing changes."""
    span = synthetic.groupBy("ticker", "concept").agg(F.min("period_end").alias("_a"), F.max("period_end").alias("_b"))
    kept = organic.join(span, ["ticker", "concept"], "left").where(F.col("_a").isNull() | ~F.col("period_end").between(F.col("_a"), F.col("_b")))
    return kept.drop("_a", "_b").unionByName(synthetic, allowMissingColumns=True)
