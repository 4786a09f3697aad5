"""SimHash near-dedup by multi-index hashing.

A fingerprint of 64 bits is cut into segments. Two fingerprints that differ
in at most ``radius`` bits differ in at most radius // segments bits of some
segment, so each fingerprint is put into the table of a segment under small
Hamming balls around its segment value, and every table match has its complete
distance verified. Texts with one fingerprint are one node.

Beyond a small radius chance would link unrelated texts of a large corpus. A
second lane of 64 bits, from remixed shingle hashes, is then verified as well.

Near copies proper are texts whose sets of five-word shingles have a
similarity of 0.8. There the fingerprints, of either lane, only propose
groups: within each proposed group the sets themselves are compared, and only
a pair that has the similarity is a link.

Within one bucket of a table the links are reduced to a spanning forest: the
first fingerprint takes all others in its reach, they take theirs, and so on.
That keeps every link's connection without writing all pairs of a dense
group, whose members mostly leave the scan with the first one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, bitmap, join_groups, marked, scratch, table, without_rows, written
from .components import components

WORDS = 4
SEED = 42
RADIUS = 4
#: For near copies in general: shingles of five words, and a similarity of 4/5.
#: Such sets differ in 9.7 bits of 64 on average, and in 19.4 of 128; a pair is
#: proposed by at most 14 bits in either lane and at most 30 in both.
COPY_WORDS, COPY_RADIUS, COPY_WHOLE = 5, 14, 30
ALIKE, ALIKE_OF = 4, 5
MOST_RADIUS = 14
#: A proposed group of more texts, or more shingles, is compared in blocks.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 22
#: Members of such a group that every block of it sees at first.
PIVOTS = 32
#: A part of a table holds about 2^15 fingerprints.
PART_LOG2 = 15
#: Pairs of fingerprints of a large bucket compared at a time.
PAIRS = 1 << 18
#: Buckets up to this size are compared all at once, shifted against themselves.
SMALL_BUCKET = 8
#: Hashes whose bits are counted at a time.
CHUNK = 1 << 16
LANE_MIX = np.uint64(0x9E3779B97F4A7C15)


def segments(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of the fewest segments, three at least, of which some
    one differs in at most two bits."""
    if not 0 <= radius <= MOST_RADIUS:
        raise ValueError(f"radius must be from 0 to {MOST_RADIUS}")
    count = max(3, radius // 3 + 1)
    edge = [64 * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(edge, edge[1:])]


def _majority(hashes: np.ndarray) -> int:
    set_ = np.zeros(64, np.int64)
    for k in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[k : k + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        set_ += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_ > len(hashes)).view(">u8")[0])


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Hashes of the word shingles of the text, A-Z lower-cased, in order. A
    text of fewer words is one shingle, a text without words (or null) has none."""
    parts = (text or b"").lower().split()
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, SEED)] if parts else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(parts) - words + 1]
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist())], np.uint64)


def _lanes(hashes: np.ndarray, lanes: int) -> list[int]:
    out = []
    for _ in range(lanes):
        out.append(_majority(hashes))
        hashes = (hashes ^ (hashes >> np.uint64(32))) * LANE_MIX
        hashes ^= hashes >> np.uint64(29)
    return out


def fingerprint(text: bytes | None, words: int = WORDS, lanes: int = 1) -> list[int]:
    """SimHash over word shingles of the text, A-Z lower-cased, per lane.

    A text of fewer words is one shingle, a text without words (or null) has
    fingerprint 0. Repeated shingles count each time.
    """
    return _lanes(shingles(text, words), lanes)


def fingerprints(docs: DataFrame, words: int = WORDS, lanes: int = 1) -> DataFrame:
    """(doc_id, text_id, node, a, b) per row: a and b hold the lanes as signed
    longs, node names the fingerprint, text_id the text."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, 2), np.uint64)
            for k, text in enumerate(batch["text"]):
                found[k, :lanes] = fingerprint(text.as_py(), words, lanes)
            a, b = (pa.array(found[:, i].copy().view(np.int64)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_id"], a, b], ["doc_id", "text_id", "a", "b"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_id"), F.col("text").cast("binary"))
    signed = rows.mapInArrow(run, f"doc_id {kind}, text_id long, a long, b long")
    return signed.withColumn("node", F.col("a") if lanes == 1 else F.xxhash64("a", "b"))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, node, a, b) per row, by the set of five-word shingles
    alone: node names the set, and a repeated shingle counts once."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, 3), np.uint64)
            for k, text in enumerate(batch["text"]):
                own = np.unique(shingles(text.as_py(), COPY_WORDS))
                found[k] = [xxhash.xxh64_intdigest(own.tobytes(), SEED), *_lanes(own, 2)]
            node, a, b = (pa.array(found[:, i].copy().view(np.int64)) for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_id"], node, a, b], ["doc_id", "text_id", "node", "a", "b"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_id"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_id long, node long, a long, b long")


def _flips(value: np.ndarray, width: int, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The table keys of segment values, and whether each is one.

    reach 0: the value alone. reach 1: also the values with one set bit
    cleared; of two values one bit apart, the one with the bit visits the
    other. reach 2: the whole ball of radius 1; values up to two bits apart
    share a centre.
    """
    yield value, np.ones(value.size, bool)
    for bit in range(width if reach else 0):
        flipped = value ^ np.uint64(1 << bit)
        yield flipped, np.ones(value.size, bool) if reach == 2 else flipped < value


def _parts(fp: Column, radius: int, low: int) -> Column:
    """The parts of the tables that hold a fingerprint's keys: segment number
    above the lowest ``low`` bits of a key."""
    cut = segments(radius)
    reach, parts = radius // len(cut), []
    for k, (shift, width) in enumerate(cut):
        kept = min(low, width)
        value = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << kept) - 1)) + F.lit(k << 32)
        parts.append(value)
        for bit in range(kept if reach else 0):
            flipped = value.bitwiseXOR(F.lit(1 << bit))
            parts.append(flipped if reach == 2 else F.when(value.bitwiseAND(F.lit(1 << bit)) != 0, flipped))
    return F.array_compact(F.array(*parts))


def table_keys(a: np.ndarray, part: int, radius: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) of the fingerprints' keys that belong to a part, by
    key; segment number above segment value."""
    cut = segments(radius)
    segment = part >> 32
    shift, width = cut[segment]
    kept = np.uint64((1 << min(low, width)) - 1)
    value = (a >> np.uint64(shift)) & np.uint64((1 << width) - 1)
    place, keys = [], []
    for key, real in _flips(value, width, radius // len(cut)):
        at = np.flatnonzero(real & ((key & kept) == np.uint64(part & 0xFFFFFFFF)))
        place.append(at)
        keys.append(key[at])
    place, keys = np.concatenate(place), np.concatenate(keys).astype(np.int64) + (segment << 32)
    order = np.argsort(keys, kind="stable")
    return place[order], keys[order]


def _near(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, radius: int, whole: int) -> np.ndarray:
    first = np.bitwise_count(a ^ c)
    return (first <= radius) & (first + np.bitwise_count(b ^ d) <= whole)


def first_shared(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    """The least table key that the fingerprints x and y both have, -1 for
    none: of the first segment in which they differ in few enough bits."""
    cut = segments(radius)
    reach, out = radius // len(cut), np.full(x.size, -1, np.int64)
    for k, (shift, width) in reversed(list(enumerate(cut))):
        mask = np.uint64((1 << width) - 1)
        p, q = (x >> np.uint64(shift)) & mask, (y >> np.uint64(shift)) & mask
        differ = p ^ q
        count = np.bitwise_count(differ)
        top = np.uint64(1) << np.maximum(np.frexp(p.astype(np.float64))[1] - 1, 0).astype(np.uint64)
        same = p & ~top if reach else p  # the highest bit cleared
        low = differ & (~differ + np.uint64(1))
        key = np.where(count == 0, same, np.where(count == 1, np.minimum(p, q), np.minimum(p ^ low, p ^ low ^ differ)))
        met = count <= reach
        if reach == 1:  # each has one bit that the other lacks, and both clear theirs
            apart = (count == 2) & ((differ & p) != 0) & ((differ & q) != 0)
            key, met = np.where(apart, p & q, key), met | apart
        out = np.where(met, key.astype(np.int64) + (k << 32), out)
    return out


def _linked(a: np.ndarray, b: np.ndarray, radius: int, whole: int) -> np.ndarray:
    """Positions of the fingerprints that have any link."""
    step, out = max(1, PAIRS // max(1, a.size)), np.zeros(a.size, bool)
    for k in range(0, a.size, step):
        x, y = np.nonzero(np.bitwise_count(a[k : k + step, None] ^ a[None]) <= radius)
        x += k
        x, y = x[x != y], y[x != y]
        out[x[_near(a[x], b[x], a[y], b[y], radius, whole)]] = True
    return np.flatnonzero(out)


def spanning(a: np.ndarray, b: np.ndarray, radius: int, whole: int) -> list[tuple[int, int]]:
    """A spanning forest, by position, of the links among the fingerprints."""
    links, rest = [], np.arange(a.size)
    while rest.size > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and rest.size:
            at = todo.pop()
            near = _near(a[rest], b[rest], a[at], b[at], radius, whole)
            if near.any():
                new = rest[near]
                links += [(at, x) for x in new]
                todo += list(new)
                rest = rest[~near]
    return links


def bucket_links(keys: np.ndarray, node: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, whole: int) -> np.ndarray:
    """Links (two columns) within each bucket; ``keys`` is sorted. All links
    in a small bucket, a spanning forest in a larger one.

    Of the buckets that two linked fingerprints share, only the one with the
    least key gives their link. What the forest of another bucket would add is
    joined there: by a forest whose links are given or, again, joined in
    buckets of lesser keys.
    """
    edge = np.flatnonzero(np.diff(keys)) + 1
    start = np.concatenate(([0], edge))
    count = np.diff(np.concatenate((start, [keys.size])))
    out = [np.zeros((0, 2), np.int64)]
    small = np.flatnonzero(np.repeat(count <= SMALL_BUCKET, count))
    k, x, y = keys[small], a[small], b[small]
    for step in range(1, SMALL_BUCKET):
        if k.size <= step:
            break
        hit = (k[step:] == k[:-step]) & _near(x[step:], y[step:], x[:-step], y[:-step], radius, whole)
        out.append(np.stack((small[:-step][hit], small[step:][hit]), axis=1))
    for s, c in zip(start[count > SMALL_BUCKET].tolist(), count[count > SMALL_BUCKET].tolist()):
        at = s + np.unique(node[s : s + c], return_index=True)[1]
        at = at[_linked(a[at], b[at], radius, whole)]
        if links := spanning(a[at], b[at], radius, whole):
            out.append(at[np.array(links)])
    found = np.concatenate(out)
    found = found[first_shared(a[found[:, 0]], a[found[:, 1]], radius) == keys[found[:, 0]]]
    found = node[found]
    found = np.sort(found[found[:, 0] != found[:, 1]], axis=1)
    return np.unique(found, axis=0) if len(found) else found


def links(nodes: DataFrame, radius: int = RADIUS, whole: int | None = None) -> DataFrame:
    """(u, v) between distinct ``nodes`` (node, a, b) whose transitive closure
    is that of all pairs at most ``radius`` bits apart in lane a and at most
    ``whole`` in both.

    The tables are cut into parts by the lowest bits of their keys, more of
    them the more nodes there are, so that a part holds a bounded number of
    fingerprints unless they are alike. A fingerprint goes once to each part
    that has keys of it, and the part finds the keys.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = 128 if whole is None else whole
    low = max(4, (nodes.count() >> PART_LOG2).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[list[np.ndarray]] = []

        def linked(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            part, node, a, b = columns
            a, b = a.view(np.uint64), b.view(np.uint64)
            edge = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [part.size])).tolist()
            for s, e in zip(edge, edge[1:]):
                at, keys = table_keys(a[s:e], int(part[s]), radius, low)
                found = bucket_links(keys, node[s:e][at], a[s:e][at], b[s:e][at], radius, both)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, i].copy()) for i in (0, 1)], ["u", "v"])

        for batch in batches:
            columns = [batch[c].to_numpy(zero_copy_only=False) for c in ("part", "node", "a", "b")]
            if not batch.num_rows:
                continue
            cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last part may go on in the next batch
            if cut:
                yield from linked([np.concatenate(x) for x in zip(*rest, [c[:cut] for c in columns])])
                rest = []
            rest.append([c[cut:] for c in columns])
        if rest:
            yield from linked([np.concatenate(x) for x in zip(*rest)])

    arrow_batches(spark, rows=200_000)
    keyed = nodes.select("node", "a", "b", F.explode(_parts(F.col("a"), radius, low)).alias("part"))
    dealt = keyed.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, radius: int = RADIUS, whole: int | None = None
) -> DataFrame:
    """Group near copies: (doc_id, text_id, a, component_id) per row of
    ``docs`` (doc_id, text); a is the fingerprint, text_id xxhash64 of text.

    component_id is the smallest doc_id reachable over links between
    fingerprints at most ``radius`` bits apart; with ``whole``, also at most
    so many bits in both lanes. Null and empty texts have fingerprint 0 and
    are linked like any other. Rows repeated under one doc_id give a row
    each. A null doc_id is a component_id only where its component has no
    other id. No documents: no rows. Other columns are ignored.
    """
    with scratch(docs.sparkSession) as keep:
        signed = written(fingerprints(docs, words, 1 if whole is None else 2), "simhash-docs")
        nodes = written(_nodes(signed), "simhash-nodes")
        return _grouped(signed, nodes, written(links(nodes, radius, whole), "simhash-links"), keep)


def _nodes(signed: DataFrame) -> DataFrame:
    return signed.groupBy("node", "a", "b").agg(
        F.min("doc_id").alias("_least"), F.min("text_id").alias("_text"), F.count("*").alias("_n")
    )


def _grouped(signed: DataFrame, nodes: DataFrame, edges: DataFrame, keep: Callable[..., None]) -> DataFrame:
    """(doc_id, text_id, a, component_id) by the components of ``edges``; of
    the tables written so far the result reads ``signed`` and one more."""
    roots = components(edges)
    placed = written(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "simhash-roots")
    least = placed.groupBy("root").agg(F.min("_least").alias("component_id"), F.count("*").alias("_m"))
    named = join_groups(placed, written(least, "simhash-least"), ["root"], "_m").select("node", "component_id", "_n")
    named = written(named, "simhash-components")
    keep(signed, named)
    return join_groups(signed, named, ["node"], "_n").select("doc_id", "text_id", "a", "component_id")


def alike(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest, by position, of the pairs of sets (each without
    repeats) that have a similarity of ALIKE / ALIKE_OF or more."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    owner = np.repeat(np.arange(len(sets)), size)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    post = owner[np.argsort(code, kind="stable")]
    start, own = np.cumsum(count) - count, np.cumsum(size) - size
    links, rest = [], np.arange(len(sets))
    while rest.size > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and rest.size:
            at = todo.pop()
            mine = code[own[at] : own[at] + size[at]]
            mine = mine[count[mine] > 1]
            many = count[mine]
            where = np.repeat(start[mine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            common = np.bincount(post[where], minlength=len(sets))[rest]
            near = ALIKE_OF * common >= ALIKE * (size[rest] + size[at] - common)
            if near.any():
                links += [(at, x) for x in rest[near]]
                todo += list(rest[near])
                rest = rest[~near]
    return links


def _alike_in(groups: DataFrame) -> DataFrame:
    """(u, v) by ``alike`` within each group of ``groups`` (group, node, grams)."""
    spark = groups.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        now = None

        def linked() -> pa.RecordBatch:
            nodes = np.array(list(held), np.int64)
            found = nodes[np.array(alike(list(held.values())), np.int64).reshape(-1, 2)]
            return pa.RecordBatch.from_arrays([pa.array(found[:, i].copy()) for i in (0, 1)], ["u", "v"])

        for batch in batches:
            for group, node, grams in zip(batch["group"].to_pylist(), batch["node"].to_pylist(), batch["grams"]):
                if group != now and held:
                    yield linked()
                    held = {}
                now = group
                held[node] = np.frombuffer(grams.as_py(), np.uint64)
        if held:
            yield linked()

    arrow_batches(spark)
    return groups.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(run, "u long, v long")


def alike_links(docs: DataFrame, nodes: DataFrame, proposed: DataFrame) -> DataFrame:
    """(u, v) between ``nodes`` of ``shingle_sets``; its closure is that of all
    pairs with the similarity within the components of ``proposed``.

    The sets of a component meet in one place, or, of a large one, first in
    blocks that share PIVOTS of its members. Where that leaves a large
    component in parts, each pair of its blocks meets.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [np.unique(shingles(t.as_py(), COPY_WORDS)) for t in batch["text"]]
            size = pa.array(list(map(len, grams)), pa.int64())
            grams = pa.array([g.tobytes() for g in grams], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["node"], batch["root"], size, grams], ["node", "root", "size", "grams"])

    members = written(nodes.join(components(proposed), "node").select("node", "root", "_text", "_n"), "simhash-members")
    texts = docs.select(F.xxhash64("text").alias("_text"), F.col("text").cast("binary"))
    # a bitmap of the members keeps other texts where they are
    texts = marked(texts, ["_text"], bitmap(members, ["_text"], "_in"), "_in").where("_in").drop("_in")
    found = join_groups(texts, members, ["_text"], "_n").select("node", "root", "text")
    arrow_batches(spark)
    sets = found.mapInArrow(run, "node long, root long, size long, grams binary").dropDuplicates(["node"])
    sets = written(sets, "simhash-sets")
    need = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
    groups = written(sets.groupBy("root").agg(need.alias("blocks"), F.count("*").alias("_m")), "simhash-groups")
    dealt = join_groups(sets, groups, ["root"], "_m")
    block = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    large = sets.select("root", "node").join(groups.where("blocks > 1").select("root"), "root")
    pivots = (
        large.groupBy("root", F.pmod("node", F.lit(PIVOTS)).alias("k")).agg(F.min("node").alias("node"))
        .select("node", F.lit(True).alias("pivot"))
    )
    seen = dealt.join(pivots, "node", "left")
    at = F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(block))
    first = seen.withColumn("at", F.explode(at)).select(F.xxhash64("root", "at").alias("group"), "node", "grams")
    edges = written(_alike_in(first), "simhash-alike")
    if groups.where("blocks > 1").isEmpty():
        return edges
    labels = large.join(components(edges).withColumnRenamed("root", "label"), "node", "left")
    parts = labels.groupBy("root").agg(F.min(F.coalesce("label", "node")).alias("x"), F.max(F.coalesce("label", "node")).alias("y"))
    open_ = parts.where("x <> y").join(groups, "root").select("root", "blocks", "_m")
    again = join_groups(sets, written(open_, "simhash-open"), ["root"], "_m").withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = again.withColumn("other", other).select(
        F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("group"), "node", "grams"
    )
    return edges.union(written(_alike_in(pairs), "simhash-alike"))


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, a, component_id) per row as of ``near_duplicates``,
    by links between texts whose shingle sets have a similarity of 0.8."""
    with scratch(docs.sparkSession) as keep:
        signed = written(shingle_sets(docs), "simhash-docs")
        nodes = written(_nodes(signed), "simhash-nodes")
        swapped = nodes.select("node", F.col("b").alias("a"), F.col("a").alias("b"))
        with scratch(docs.sparkSession) as keep_links:
            proposed = [written(links(n, COPY_RADIUS, COPY_WHOLE), "simhash-links") for n in (nodes, swapped)]
            verified = written(alike_links(docs, nodes, proposed[0].union(proposed[1])), "simhash-verified")
            keep_links(verified)
        return _grouped(signed, nodes, verified, keep)


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies, that with the smallest
    doc_id, with all columns of ``docs``; near copies share 0.8 of their
    shingles of five words, or are joined by a chain of such pairs.

    Rows with equal doc_id and equal text stay or go together; a document
    without an id stays only in a group without any.
    """
    with scratch(docs.sparkSession) as keep:
        gone = near_copies(docs).where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        return without_rows(docs, gone, keep)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("a"), 16, "0")).alias("fingerprint"), "component_id")
