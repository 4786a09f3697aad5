"""Personal data and what gives it away, with DataFrame functions only.

Base kinds are found by their patterns. The information-theoretic part then
asks of every term near a found entity how much of the entity it discloses.
Copies count once: with N different texts, c(e) with entity e, c(t) with term t and c(e, t) with t near
e, the pointwise mutual information log(c(e, t) N / (c(e) c(t))) is compared
with the entity's information content log(N / c(e)). A term that gives away
at least DISCLOSURE of it, in at least SUPPORT different texts, is a span of
kind ``term`` beside that entity: it is generalised if it is common enough to
stand for something, and removed if not.

Places come from matches and the gaps between them, so the JVM's own regular
expressions do the work. A pattern with a possessive repeat, begun only where
a run begins or the match before ended, finds what the stated pattern finds
but in linear time and constant stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_names, join_groups, table, written

LOCAL = "[A-Za-z0-9._%+-]"
LABEL = "[A-Za-z0-9-]"
#: In the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = (
    rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: A text without this character has no match; None: no such character.
NEEDS = ("@", None, None, "+")
BYTE = "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"

#: Characters on each side of an entity that are its context in ``find``; the
#: query and ``sanitise`` take whole texts.
CONTEXT = 64
TERM = r"\p{L}+"
SHORTEST_TERM = 3
SUPPORT = 3
DISCLOSURE = 0.9
#: A term in so many documents is generalised, a rarer one is removed.
COMMON = 10
SPANS = "array<struct<kind:int,first:int,end:int,value:string,common:boolean>>"


def _finds(text: Column, context: int | None) -> Column:
    """Of each kind with a match: kind, values, and the gaps around them as
    length, first and last ``context`` characters (None: none are needed)."""
    kept = context or 0
    kinds = []
    for k, (pattern, needs) in enumerate(zip(PATTERNS, NEEDS)):
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        if needs:
            values = F.when(F.contains(text, F.lit(needs)), values).otherwise(F.array().cast("array<string>"))
        gaps = F.transform(
            F.when(F.size(values) > 0, F.split(text, pattern, -1)),
            lambda g: F.struct(
                F.char_length(g).alias("n"), F.left(g, F.lit(kept)).alias("head"), F.right(g, F.lit(kept)).alias("tail")
            ),
        )
        kinds.append(F.struct(F.lit(k).alias("kind"), values.alias("found"), gaps.alias("gaps")))
    return F.filter(F.array(*kinds), lambda x: F.size(x["found"]) > 0)


def _luhn(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)


def _valid(kind: Column, value: Column) -> Column:
    count = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (
        F.when(kind == 1, F.forall(F.split(value, r"\."), lambda p: p.rlike(BYTE)))
        .when(kind == 2, _luhn(value))
        .when(kind == 3, count.between(9, 15))
        .otherwise(True)
    )


def _terms(context: Column, cut: Column, at_head: bool, offset: Column) -> Column:
    """(term, first, end) of the words in a context of at most CONTEXT
    characters. A word at the cut side of a cut context may be half a word
    and is left out. ``offset`` is where the context begins in the text."""
    words, gaps = F.regexp_extract_all(context, F.lit(TERM), F.lit(0)), F.split(context, TERM, -1)

    def length(parts: Column, n: Column) -> Column:
        return F.aggregate(F.slice(parts, F.lit(1), n), F.lit(0), lambda a, x: a + F.char_length(x))

    placed = F.transform(
        words,
        lambda w, i: F.struct(
            F.lower(w).alias("term"), (length(gaps, i + 1) + length(words, i)).alias("at"), F.char_length(w).alias("size")
        ),
    )
    whole = F.filter(
        placed,
        lambda x: (x["size"] >= SHORTEST_TERM)
        & ~(cut & (x["at"] == 0 if at_head else x["at"] + x["size"] == F.char_length(context))),
    )
    return F.transform(
        whole,
        lambda x: F.struct(x["term"].alias("term"), (offset + x["at"]).alias("first"), (offset + x["at"] + x["size"]).alias("end")),
    )


def _mentions(rows: DataFrame, context: int | None) -> DataFrame:
    """One valid base match a row: row, text_id, kind, value, first, end, and,
    with a ``context``, the terms in it."""
    each = rows.select("row", "text_id", F.inline("finds")).select(
        "row", "text_id", "kind",
        F.inline(
            F.transform(
                "found",
                lambda v, i: F.struct(
                    i.alias("i"), v.alias("value"), F.get("gaps", i).alias("before"), F.get("gaps", i + 1).alias("after")
                ),
            )
        ),
    )
    so_far = Window.partitionBy("row", "kind").orderBy("i")
    placed = each.withColumn(
        "end", F.sum(F.col("before.n") + F.char_length("value")).over(so_far).cast("int")
    ).withColumn("first", F.col("end") - F.char_length("value"))
    valid = placed.where(_valid(F.col("kind"), F.col("value")))
    base = ["row", "text_id", "kind", "value", "first", "end"]
    if context is None:
        return valid.select(*base)
    tail, head = F.col("before.tail"), F.col("after.head")
    left = _terms(tail, F.col("before.n") > context, True, F.col("first") - F.char_length(tail))
    right = _terms(head, F.col("after.n") > context, False, F.col("end"))
    return valid.select(*base, F.concat(left, right).alias("terms"))


def _words(text: Column) -> Column:
    """The different terms of a text."""
    words = F.filter(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda w: F.char_length(w) >= SHORTEST_TERM)
    return F.array_distinct(F.transform(words, lambda w: F.lower(w)))


def _marked(texts: DataFrame) -> DataFrame:
    """(row, kind, first, end, value, common) wherever in a text of ``texts``
    (row, text, telling) a term of the map ``telling`` (term, common) stands."""
    words, gaps = F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), F.split("text", TERM, -1)
    each = texts.select("row", "telling", words.alias("words"), gaps.alias("gaps")).select(
        "row", "telling", F.posexplode(F.zip_with("words", "gaps", lambda w, g: F.struct(w.alias("word"), F.char_length(g).alias("gap")))).alias("i", "x")
    ).where("x.word IS NOT NULL")
    term, size = F.lower("x.word"), F.char_length("x.word")
    parts = each.select("row", "i", (F.col("x.gap") + size).alias("step"), size.alias("size"), term.alias("value"), F.element_at("telling", term).alias("common"))
    so_far = Window.partitionBy("row").orderBy("i")
    placed = parts.withColumn("end", F.sum("step").over(so_far).cast("int")).where("common IS NOT NULL")
    return placed.select("row", F.lit(len(KINDS) - 1).alias("kind"), (F.col("end") - F.col("size")).alias("first"), "end", "value", "common")


def _document_counts(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(term, documents) for the candidate terms, over all distinct texts. Words
    are counted on the map side first, so a frequent one shuffles as one row
    per task; candidates meet the counts, not the words."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    texts = docs.groupBy(F.xxhash64("text")).agg(F.first("text").alias("text"))
    each = texts.select(F.explode(words).alias("term")).where(F.char_length("term") >= SHORTEST_TERM)
    counted = each.groupBy("term").agg(F.count("*").alias("documents"))
    # an inner join: the optimizer would push a semi join below the counting
    return counted.join(candidates, "term")


def _shared(mentions: DataFrame) -> DataFrame:
    """(kind, value, texts, mentions) of the entities in SUPPORT texts or
    more; no term has its evidence beside a rarer one."""
    each = mentions.groupBy("kind", "value", "text_id").agg(F.count("*").alias("n"))
    entities = each.groupBy("kind", "value").agg(F.count("*").alias("texts"), F.sum("n").alias("mentions"))
    return entities.where(F.col("texts") >= SUPPORT)


def _beside(texts: DataFrame, mentions: DataFrame, shared: DataFrame) -> DataFrame:
    """(kind, value, text_id, term): the different terms of every whole text
    with a shared entity, copies once."""
    held = join_groups(mentions.select("row", "text_id", "kind", "value"), shared, ["kind", "value"], "mentions")
    one = held.groupBy("kind", "value", "text_id").agg(F.min("row").alias("row"))
    terms = texts.join(one.select("row").distinct(), "row").select("row", _words(F.col("text")).alias("terms"))
    return one.join(terms, "row").select("kind", "value", "text_id", F.explode("terms").alias("term"))


def find(docs: DataFrame, row: str | None = None, context: int | None = CONTEXT) -> DataFrame:
    """Spans of personal data in each row of ``docs`` (doc_id, text).

    Returns row (the column ``row``, or else a number), doc_id, and spans: an array of
    (kind, first, end, value, common) by kind as in KINDS, then place; places
    are code points, end exclusive; kind is an index into KINDS; common tells
    whether a term is generalised rather than removed, null for other kinds.

    A null text counts as empty and has no spans. Rows repeated under one
    doc_id, also null, are rows of their own; rows with one text count once
    as evidence. An empty table gives no rows. Other columns are ignored.

    Terms are looked for, and marked, within ``context`` characters of an
    entity; with None in the whole of each text that has the entity.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row"), "doc_id", text.alias("text")).select(
        "row", "doc_id", F.xxhash64("text").alias("text_id"), _finds(F.col("text"), context).alias("finds"), "text"
    )
    # whole texts are read again, but only those with a find
    held = F.when(F.size("finds") > 0, F.col("text")) if context is None else F.lit(None).cast("string")
    rows = written(found.withColumn("text", held), "pii-rows")
    mentions = written(_mentions(rows.where(F.size("finds") > 0), context), "pii-mentions")
    entity, entities = ["kind", "value"], written(_shared(mentions), "pii-entities")
    if context is None:
        near = _beside(rows.select("row", "text"), mentions, entities)
    else:
        near = mentions.select("row", "text_id", *entity, F.inline("terms"))
    pairs = (
        near.groupBy(*entity, "term", "text_id").agg(F.count("*").alias("n"))
        .groupBy(*entity, "term").agg(F.count("*").alias("joint"), F.sum("n").alias("n"))
        .where(F.col("joint") >= SUPPORT)
    )
    supported = written(pairs.join(entities, entity), "pii-pairs")
    documents = rows.select("text_id").distinct().count()
    known = _document_counts(docs.select(text.alias("text")), supported.select("term").distinct())
    bits = F.log2(F.col("joint") * documents / (F.col("texts") * F.col("documents")))
    content = F.log2(F.lit(documents) / F.col("texts"))
    telling = written(
        supported.join(known, "term").where((content > 0) & (bits >= DISCLOSURE * content))
        .select(*entity, "term", "n", "mentions", (F.col("documents") >= COMMON).alias("common")),
        "pii-terms",
    )
    if context is None:
        told = join_groups(mentions.select("row", *entity).distinct(), telling.groupBy(*entity).agg(
            F.collect_list(F.struct("term", "common")).alias("telling"), F.max("mentions").alias("mentions")), entity, "mentions")
        asked = told.groupBy("row").agg(F.map_from_entries(F.array_distinct(F.flatten(F.collect_list("telling")))).alias("telling"))
        terms = _marked(rows.select("row", "text").join(asked, "row"))
    else:
        terms = join_groups(near, telling, [*entity, "term"], "n").select(
            "row", F.lit(len(KINDS) - 1).alias("kind"), "first", "end", F.col("term").alias("value"), "common"
        )
    base = mentions.select("row", "kind", "first", "end", "value", F.lit(None).cast("boolean").alias("common"))
    spans = (
        base.unionByName(terms.distinct()).groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("kind", "first", "end", "value", "common"))).alias("spans"))
    )
    none = F.array().cast(SPANS)
    return rows.select("row", "doc_id").join(spans, "row", "left").withColumn("spans", F.coalesce("spans", none))


def replaced(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind, or, for a term, by
    ``[term]`` or nothing. Of overlapping spans the first covers the rest."""
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["first"], s["end"], s["kind"], s["common"])))
    label = F.array(*(F.lit(f"[{k}]") for k in KINDS))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        shown = F.when((s["kind"] == len(KINDS) - 1) & ~s["common"], F.lit("")).otherwise(F.get(label, s["kind"]))
        more = F.concat(done["out"], F.substring(text, done["at"] + 1, s["first"] - done["at"]), shown)
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"), F.when(s["first"] >= done["at"], more).otherwise(done["out"]).alias("out")
        )

    return F.aggregate(
        by_place, begin, step,
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text))),
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``find`` replaced in the column text; every
    row and column stays, a null text stays null."""
    row, spans = free_names(docs, "_row", "_spans")
    keyed = written(docs.withColumn(row, F.monotonically_increasing_id()), "pii-keyed")
    found = find(keyed, row, None).where(F.size("spans") > 0).select(F.col("row").alias(row), F.col("spans").alias(spans))
    clean = F.when(F.col(spans).isNull(), F.col("text")).otherwise(replaced(F.col("text"), F.col(spans)))
    return keyed.join(found, row, "left").select(*(clean.alias(c) if c == "text" else F.col(c) for c in docs.columns))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), context=None)
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS) - 1)

    def written_out(spans: Column) -> Column:
        names = F.array(*(F.lit(k) for k in KINDS))
        return F.concat_ws(
            ",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["first"].cast("string"), s["end"].cast("string")))
        )

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:-1])]
    return found.select("doc_id", *counts, F.sha2(written_out(base).cast("binary"), 256).alias("base_sha256"), written_out(F.col("spans")).alias("spans"))
