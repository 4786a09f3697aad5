"""Benchmark decontamination with an FM-index per shard of training text.

The benchmark's windows are the patterns. A shard is SHARD_WORDS words or
more of documents, or one longer document. Its words become numbers of the
benchmark's vocabulary; a word outside it ends every match, so runs of them
are one separator and stretches between separators that are shorter than the
shortest window are left out of the index, which changes no match. Backward
search finds the rows of each window, sampled suffix positions locate them,
and the located word spans are merged.

Documents never move: patterns are broadcast in blocks of at most
BLOCK_WINDOWS windows, which a task loads one after the other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, table
from .fm_index import FMIndex

WINDOW = 10
SHARD_WORDS = 1 << 21
BLOCK_WINDOWS = 1 << 18
SEPARATOR = 1
#: Most located occurrences in memory at a time.
LOCATE_ROWS = 1 << 20

#: Bytes to word bytes: A-Z lower-cased; 0-9, a-z and all of 128 up stay;
#: everything else ends a word.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


@dataclass
class Patterns:
    """A block of benchmark windows. numbers: of each word of the block, from
    2 up. windows: by length, a matrix of word numbers. owners: by length,
    for each window the positions of its items in ``items``."""

    items: list
    numbers: dict[bytes, int]
    windows: dict[int, np.ndarray]
    owners: dict[int, list[list[int]]]


def patterns_of(items: list[tuple[object, list[bytes]]], window: int) -> Patterns:
    names = sorted({str(i): i for i, _ in items}.items())
    place = {name: k for k, (name, _) in enumerate(names)}
    numbers: dict[bytes, int] = {}
    found: dict[int, dict[tuple[int, ...], set[int]]] = {}
    for item, words in items:
        coded = [numbers.setdefault(w, len(numbers) + 2) for w in words]
        size = min(window, len(coded))
        for k in range(len(coded) - size + 1 if size else 0):
            found.setdefault(size, {}).setdefault(tuple(coded[k : k + size]), set()).add(place[str(item)])
    return Patterns(
        [i for _, i in names],
        numbers,
        {size: np.array(list(by), np.int64).reshape(len(by), size) for size, by in found.items()},
        {size: [sorted(own) for own in by.values()] for size, by in found.items()},
    )


def blocks(benchmark: DataFrame, window: int) -> Iterator[Patterns]:
    """The benchmark in blocks; items come to the driver one after the other
    and a block is dropped once it is broadcast."""
    held, count = [], 0
    for item, text in benchmark.select("item_id", F.col("text").cast("binary")).toLocalIterator():
        words = words_of(bytes(text) if text is not None else None)
        if held and count + len(words) > BLOCK_WINDOWS:
            yield patterns_of(held, window)
            held, count = [], 0
        if item is not None and words:
            held.append((item, words))
            count += len(words)
    yield patterns_of(held, window)


def shard_hits(docs: list[list[bytes]], block: Patterns) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first word, end word, item) of each occurrence in a shard."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    if not block.windows:
        return none
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    number = block.numbers.get
    coded = np.fromiter((number(w, SEPARATOR) for words in docs for w in words), np.int64, int(lengths.sum()))
    doc = np.repeat(np.arange(len(docs)), lengths)
    known = np.flatnonzero(coded != SEPARATOR)
    if not known.size:
        return none
    fresh = np.concatenate(([True], (np.diff(known) > 1) | (np.diff(doc[known]) > 0)))
    start = np.flatnonzero(fresh)
    size = np.diff(np.append(start, known.size))
    long = size >= min(block.windows)
    kept = known[np.repeat(long, size)]
    if not kept.size:
        return none
    # a separator stands before each stretch but the first
    shift = np.repeat(np.arange(int(long.sum())), size[long])
    text = np.full(kept.size + int(long.sum()) - 1, SEPARATOR, np.int64)
    text[np.arange(kept.size) + shift] = coded[kept]
    origin = np.full(text.size, -1, np.int64)
    origin[np.arange(kept.size) + shift] = kept
    index = FMIndex(text, len(block.numbers) + 1)
    begins = np.cumsum(lengths) - lengths
    out = [none]
    for width, windows in block.windows.items():
        low, high = index.search(windows)
        hit = np.flatnonzero(high > low)
        count = high[hit] - low[hit]
        for part in np.split(hit, np.flatnonzero(np.diff(np.cumsum(count) // LOCATE_ROWS)) + 1):
            if not part.size:
                continue
            n = high[part] - low[part]
            rows = np.repeat(low[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            at = origin[index.locate(rows)]
            owners = [block.owners[width][p] for p in part.tolist()]
            own = np.repeat(np.fromiter(map(len, owners), np.int64, len(owners)), n)
            at, items = np.repeat(at, own), np.concatenate([np.tile(o, k) for o, k in zip(owners, n.tolist())])
            first = at - begins[doc[at]]
            out.append((doc[at], first, first + width, items))
    return tuple(np.concatenate(x) for x in zip(*out))


def merged(doc: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching word spans of each document made one."""
    if not doc.size:
        return doc, first, end
    order = np.lexsort((first, doc))
    doc, first, end = doc[order], first[order], end[order]
    # beyond any word number of the documents before
    base = doc * (int(end.max()) + 2)
    reach = np.maximum.accumulate(base + end)
    fresh = np.concatenate(([True], base[1:] + first[1:] > reach[:-1]))
    start = np.flatnonzero(fresh)
    return doc[start], first[start], (reach - base)[np.append(start[1:], doc.size) - 1]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Benchmark passages in each row of ``docs`` (doc_id, text).

    Returns doc_id, n_words, n_hit (words inside any occurrence), items (ids
    with an occurring window, as strings in order), and spans (merged
    [first, end) word numbers).

    A window is ``window`` consecutive words of an item; an item of fewer
    words is one window; an item without words or without an id is none. Rows
    repeated under one item_id are parts of one item. A null text has no
    words. Rows repeated under one doc_id give a row each; a null doc_id
    stays null. An empty benchmark hits nothing. Other columns are ignored.
    """
    arrow_batches(docs.sparkSession)
    shared = _broadcast(benchmark, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, texts in _shards(batches):
            first, end, doc, items = _scan(texts, shared)
            ends = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(texts)))))
            pairs = pa.StructArray.from_arrays([pa.array(first), pa.array(end)], ["first", "end"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.chunked_array([x["doc_id"] for x in held]).combine_chunks(),
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array(np.bincount(doc, end - first, len(texts)).astype(np.int64)),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pairs),
                ],
                ["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        run,
        f"doc_id {kind}, n_words long, n_hit long, items array<string>, spans array<struct<first: long, end: long>>",
    )


def _broadcast(benchmark: DataFrame, window: int) -> list:
    return [benchmark.sparkSession.sparkContext.broadcast(block) for block in blocks(benchmark, window)]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[list[bytes]]]]:
    """Slices of batches with their rows' words, SHARD_WORDS or more of them."""
    held, texts, size = [], [], 0
    for batch in batches:
        begin = 0
        for k, text in enumerate(batch["text"]):
            raw = text.as_py()
            texts.append(words_of(raw.encode() if isinstance(raw, str) else raw))
            size += len(texts[-1])
            if size >= SHARD_WORDS:
                yield [*held, batch.slice(begin, k + 1 - begin)], texts
                held, texts, size, begin = [], [], 0, k + 1
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if held:
        yield held, texts


def _scan(texts: list[list[bytes]], shared: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[set[str]]]:
    """Merged spans (first, end, doc) of a shard, and the items of each row;
    the blocks of the benchmark are loaded one after the other, and only one
    is in memory."""
    doc, first, end = (np.zeros(0, np.int64) for _ in range(3))
    items: list[set[str]] = [set() for _ in texts]
    for part in shared:
        block = part.value
        if len(shared) > 1:
            # the worker would keep every block it has read; the file stays
            part.__dict__.pop("_value", None)
        d, f, e, owner = shard_hits(texts, block)
        for a, b in np.unique(np.stack((d, owner), 1), axis=0).tolist():
            items[a].add(str(block.items[b]))
        doc, first, end = merged(*(np.concatenate(x) for x in ((doc, d), (first, f), (end, e))))
    return first, end, doc, items


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, with
    all their columns. Rows and windows as in ``contamination``."""
    arrow_batches(docs.sparkSession)
    shared = _broadcast(benchmark, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, texts in _shards(batches):
            _, _, doc, _ = _scan(texts, shared)
            clean = np.bincount(doc, minlength=len(texts)) == 0
            at = 0
            for batch in held:
                yield batch.filter(pa.array(clean[at : at + batch.num_rows]))
                at += batch.num_rows

    return docs.mapInArrow(run, docs.schema)


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` (as ``contamination`` returns
    them) and what stands between them."""
    places = [(m.start(), m.end()) for m in WORD.finditer(text)]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Every word sequence of a document as long as some window, joined with the
#: windows; hit words are counted once.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
  FROM documents
),
b AS (
  SELECT item_id, w, least(10, len(w)) AS size FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL)
  WHERE len(w) > 0
),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[k:k + size - 1], ' ') AS win
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM b)
),
grams AS (
  SELECT r, size, k, array_to_string(w[k:k + size - 1], ' ') AS win
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM windows))
),
hits AS (SELECT g.r, g.k, g.size, v.item_id FROM grams g JOIN windows v ON v.size = g.size AND v.win = g.win),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places ON places.r = d.r LEFT JOIN items ON items.r = d.r
"""
