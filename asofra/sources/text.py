"""Parsers for JSON, HTML and text fields, as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Entities in the order in which they are decoded.
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"))
OBSERVATION = "struct<val:double,end:date,start:date,filed:date,form:string,accn:string,fy:int,fp:string>"
FACTS = f"struct<cik:long,entityName:string,facts:map<string,map<string,struct<units:map<string,array<{OBSERVATION}>>>>>>"
NAMESPACES = ("us-gaap", "dei")


def decode_entities(text: Column) -> Column:
    for entity, plain in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def without_markup(html: Column) -> Column:
    return F.trim(F.regexp_replace(decode_entities(F.regexp_replace(html, "<[^>]*>", " ")), r"[\x20\t\r\n]+", " "))


def linked_label(html: Column, prefix: str) -> Column:
    """The text of the first link whose address holds ``f=<prefix>_``."""
    found = F.regexp_extract(html, rf'(?s)<a[^>]+href="[^"]*f={prefix}_[^"]*"[^>]*>(.*?)</a>', 1)
    return F.when(found != "", without_markup(found))


def company_facts(raw: DataFrame, tags: DataFrame, column: str = "json") -> DataFrame:
    """Long fact rows of company JSON documents, for the mapped tags only.

    ``tags`` (tag, concept, tag_rank) has one row per mapped tag, so its
    broadcast is bounded by the constant table.
    """
    parsed = raw.select(F.from_json(column, FACTS).alias("j")).select(F.lpad(F.col("j.cik").cast("string"), 10, "0").alias("cik"), F.explode("j.facts").alias("space", "byTag"))
    by_tag = parsed.where(F.col("space").isin(*NAMESPACES)).select("cik", F.explode("byTag").alias("tag", "u"))
    mapped = by_tag.join(F.broadcast(tags), "tag").select("cik", "tag", "concept", "tag_rank", F.explode("u.units").alias("unit", "rows"))
    rows = mapped.select("cik", "tag", "concept", "tag_rank", "unit", F.inline("rows"))
    return rows.select(
        "cik", "concept", "tag", "tag_rank", F.col("val").alias("value"), F.col("start").alias("period_start"), F.col("end").alias("period_end"),
        "filed", "form", F.col("accn").alias("accession"), F.col("fy").alias("fiscal_year"), F.col("fp").alias("fiscal_qtr"), "unit",
    )


_ARRAYS = "struct<accessionNumber:array<string>,filingDate:array<date>,form:array<string>,primaryDocument:array<string>>"


def _filings(parsed: DataFrame, forms: list[str]) -> DataFrame:
    rows = parsed.select("cik", F.inline(F.arrays_zip("r.accessionNumber", "r.filingDate", "r.form", "r.primaryDocument")))
    named = rows.toDF("cik", "accession", "filed", "form", "document")
    return named.where(F.col("form").isin(*forms))


def filing_index(raw: DataFrame, forms: list[str], column: str = "json") -> DataFrame:
    """(cik, accession, filed, form, document) rows from the parallel arrays
    of a filing index document."""
    schema = f"struct<cik:string,filings:struct<recent:{_ARRAYS}>>"
    parsed = raw.select(F.from_json(column, schema).alias("j")).select(F.lpad("j.cik", 10, "0").alias("cik"), F.col("j.filings.recent").alias("r"))
    return _filings(parsed, forms)


def index_pages(raw: DataFrame, start: str, end: str, column: str = "json") -> DataFrame:
    """(cik, page): the further pages of a filing index that hold filings of
    [start, end]; others need not be fetched."""
    schema = "struct<cik:string,filings:struct<files:array<struct<name:string,filingFrom:date,filingTo:date>>>>"
    parsed = raw.select(F.from_json(column, schema).alias("j")).select(F.lpad("j.cik", 10, "0").alias("cik"), F.inline("j.filings.files"))
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return parsed.where((F.col("filingTo") >= first) & (F.col("filingFrom") <= last)).select("cik", F.col("name").alias("page"))


def index_page_filings(raw: DataFrame, forms: list[str], column: str = "json") -> DataFrame:
    """Rows as of ``filing_index`` from its further pages (cik, json), each
    the bare arrays."""
    return _filings(raw.select(F.lpad("cik", 10, "0").alias("cik"), F.from_json(column, _ARRAYS).alias("r")), forms)


def instance_documents(listing: DataFrame) -> DataFrame:
    """(accession, document, state) from the files (accession, name, size) of
    each filing: the converted instance ``*_htm.xml``, else ``abc-20240331.xml``,
    else the largest XML file that is no linkbase or report. state is found,
    or none for good; an accession whose listing could not be read has a row
    without a name and is to be asked again."""
    name = F.lower("name")
    dated = name.rlike(r"^[a-z0-9]+-[0-9]{8}\.xml$")
    other = name.endswith(".xml") & ~name.rlike(r"(_cal|_def|_lab|_pre)\.xml$|^filingsummary\.xml$|^r[0-9]+\.xml$")
    rank = F.when(name.endswith("_htm.xml"), 0).when(dated, 1).when(other, 2)
    best = F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), (-F.coalesce("size", F.lit(0))).alias("size"), F.col("name").alias("name")))).alias("_b")
    agg = listing.groupBy("accession").agg(best, F.count("name").alias("_n"))
    state = F.when(F.col("_n") == 0, "retry").when(F.col("_b").isNull(), "none").otherwise("found")
    return agg.select("accession", F.col("_b.name").alias("document"), state.alias("state"))


def company_text(candidates: DataFrame, companies: DataFrame) -> DataFrame:
    """(ticker, description, source): the first candidate article (ticker,
    rank, title, text) that is about a company, else the industry label
    (ticker, sic_description)."""
    good = candidates.where(is_company_like(F.col("title"), F.col("text")))
    best = good.groupBy("ticker").agg(F.min(F.struct("rank", "title", "text")).alias("_b"))
    met = companies.join(best, "ticker", "left")
    source = F.when(F.col("_b").isNotNull(), "article").when(F.col("sic_description").isNotNull(), "label")
    return met.select("ticker", F.coalesce("_b.text", "sic_description").alias("description"), source.alias("source"))


def is_company_like(title: Column, text: Column) -> Column:
    """Whether an article is about a company: not a list or disambiguation
    page, long enough, and with a company word."""
    bad = title.rlike(r"(?i)^(list of|index of|history of)|\(disambiguation\)") | text.rlike(r"(?i)may refer to")
    return ~bad & (F.char_length(text) >= 80) & text.rlike(r"(?i)\b(company|corporation|inc|firm|manufacturer|bank|holding|provider|retailer|utility)\b")
