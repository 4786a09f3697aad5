"""Byte-level BPE by a global shuffle of distinct words.

Documents are cut into pre-tokens in blocks of BLOCK_BYTES of text. A block
lists its distinct pre-tokens once and keeps, for each position, the number of
the pre-token there. The lists go to buckets by a hash of the word, packed by
(block, bucket); each bucket encodes every distinct word once and sends the
ids back to the blocks, which put them together by position. No shuffle
carries a word once per occurrence. Decoding joins each id with the
token-byte table.

A block is named after its partition, its number there and a digest of its
texts. Blocks are made twice, for the words and for the positions; if a
nondeterministic input made them differ, the join would miss and raise.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_batches, table

BLOCK_BYTES = 4 << 20
#: Positions put together at a time.
CHUNK = 1 << 18
#: Distinct words that a task remembers; beyond, it begins anew and encodes a
#: word again that it has forgotten.
MOST_KNOWN = 1 << 20
#: Word buckets per shuffle partition.
SPREAD = 4


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The rank file: base64 of a token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _pack(*arrays: np.ndarray, blob: bytes = b"") -> bytes:
    """Compressed integers below 2^31, and bytes. Equal bytes of the numbers
    stand together, which compresses better."""
    sizes = np.array([len(arrays), *map(len, arrays)], np.int32)
    planes = (np.ascontiguousarray(a.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes() for a in arrays)
    return zstandard.compress(b"".join([sizes.tobytes(), *planes, blob]), 3)


def _unpack(packed: bytes) -> tuple[list[np.ndarray], bytes]:
    whole = zstandard.decompress(packed)
    count = int(np.frombuffer(whole, np.int32, 1)[0])
    at, arrays = 4 * (count + 1), []
    for size in np.frombuffer(whole, np.int32, count, 4).tolist():
        planes = np.frombuffer(whole, np.uint8, 4 * size, at).reshape(4, size)
        arrays.append(np.ascontiguousarray(planes.T).view("<i4").reshape(-1))
        at += 4 * size
    return arrays, whole[at:]


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[tuple[str, dict[str, int], list, list]]:
    """(name, distinct words in order, doc_ids, word numbers per document)."""
    compiled = regex.compile(pattern)
    find, each = compiled.findall, compiled.finditer
    context = TaskContext.get()
    place = context.partitionId() if context else 0
    seen, count = xxhash.xxh3_64(), 0
    words: dict[str, int] = {}
    ids, numbers, size = [], [], 0

    def number(word: str) -> int:
        return words.setdefault(word, len(words))

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            text = text or ""
            raw = text.encode()
            if size and size + len(raw) > BLOCK_BYTES:
                yield f"{place}-{count}-{seen.hexdigest()}", words, ids, numbers
                seen, count = xxhash.xxh3_64(), count + 1
                words = {}
                ids, numbers, size = [], [], 0
            # the matches of a long text one by one
            found = find(text) if len(raw) < BLOCK_BYTES else (m[0] for m in each(text))
            numbers.append(np.fromiter(map(number, found), np.int32))
            ids.append(doc_id)
            size += len(raw)
            seen.update(len(raw).to_bytes(8, "little") + raw)
    if ids:
        yield f"{place}-{count}-{seen.hexdigest()}", words, ids, numbers


def _ragged(flat: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The elements of ``rows`` of a ragged array, one after the other, and
    their counts."""
    starts = np.cumsum(counts) - counts
    picked = counts[rows]
    ends = np.cumsum(picked)
    where = np.arange(ends[-1] if ends.size else 0) + np.repeat(starts[rows] - (ends - picked), picked)
    return flat[where], picked


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) per row of ``docs`` (doc_id, text); with
    ``decoded`` also the bytes that the ids decode to, by the same worker.

    Each match of ``pattern`` is merged by ``ranks`` separately, without
    special tokens. A null or empty text has no ids. Rows repeated under one
    doc_id give a row each; a null doc_id stays null. An empty table gives no
    rows. Columns besides doc_id and text are ignored; doc_id may have any
    type. A word of any length is encoded whole; a text may have as many ids
    as an Arrow list (2^31).
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast((ranks, pattern))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = SPREAD * parts
    kind = docs.schema["doc_id"].dataType.simpleString()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, distinct, _, _ in _blocks(batches, shared.value[1]):
            raw = [w.encode() for w in distinct]
            bucket = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)) % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            groups = [g for g in np.split(order, cuts) if g.size]
            packed = []
            for g in groups:
                mine = [raw[i] for i in g.tolist()]
                packed.append(_pack(g, np.fromiter(map(len, mine), np.int32, len(mine)), blob=b"".join(mine)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(groups), pa.string()),
                    pa.array([int(bucket[g[0]]) for g in groups], pa.int32()),
                    pa.array(packed, pa.binary()),
                ],
                ["block", "bucket", "words"],
            )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = tiktoken.Encoding(
            "ranks", pat_str=shared.value[1], mergeable_ranks=shared.value[0], special_tokens={}
        )._core_bpe
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            out = []
            for packed in batch["words"]:
                (places, sizes), blob = _unpack(packed.as_py())
                ends = np.cumsum(sizes)
                found = []
                for a, b in zip((ends - sizes).tolist(), ends.tolist()):
                    word = blob[a:b]
                    ids = known.get(word)
                    if ids is None:
                        if len(known) >= MOST_KNOWN:
                            known.clear()
                        ids = known[word] = core.encode_single_piece(word)
                    found.append(ids)
                counts = np.fromiter(map(len, found), np.int32, len(found))
                out.append(_pack(places, counts, np.array([i for ids in found for i in ids], np.int32)))
            yield pa.RecordBatch.from_arrays([batch["block"], pa.array(out, pa.binary())], ["block", "ids"])

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, ids, numbers in _blocks(batches, shared.value[1]):
            sizes = np.fromiter(map(len, numbers), np.int32, len(numbers))
            packed = _pack(sizes, np.concatenate(numbers))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([ids], pa.list_(batches_kind)), pa.array([packed], pa.binary())],
                ["block", "doc_ids", "numbers"],
            )

    def together(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows != 1:
            raise RuntimeError("a block's words have no positions: the input is not deterministic")
        (sizes, numbers), _ = _unpack(left["numbers"][0].as_py())
        parts = [_unpack(x.as_py())[0] for x in right["ids"]]
        places, counts, flat = (
            np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int32) for i in range(3)
        )
        if numbers.size and (not places.size or int(numbers.max()) >= places.size):
            raise RuntimeError("a block's positions have no words: the input is not deterministic")
        row = np.empty(places.size, np.int64)
        row[places] = np.arange(places.size)
        cuts = [numbers[k : k + CHUNK] for k in range(0, numbers.size, CHUNK)]
        ids = np.concatenate([flat[:0], *(_ragged(flat, counts, row[cut])[0] for cut in cuts)])
        before = np.zeros(numbers.size + 1, np.int32)
        for k, cut in enumerate(cuts):
            before[1 + k * CHUNK : 1 + k * CHUNK + cut.size] = counts[row[cut]]
        ends = np.cumsum(before, dtype=np.int32)[np.concatenate(([0], np.cumsum(sizes)))]
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
        out = {"doc_id": left["doc_ids"].combine_chunks().flatten(), "ids": lists}
        return pa.table(out | ({"decoded": TokenBytes(shared.value[0]).decode(lists)} if decoded else {}))

    batches_kind = to_arrow_type(docs.schema["doc_id"].dataType)
    base = docs.select("doc_id", "text")
    by_word = base.mapInArrow(words, "block string, bucket int, words binary").repartition(parts, "bucket")
    sent_back = by_word.mapInArrow(encoded, "block string, ids binary")
    placed = base.mapInArrow(positions, f"block string, doc_ids array<{kind}>, numbers binary")
    return (
        placed.groupBy("block")
        .cogroup(sent_back.groupBy("block"))
        .applyInArrow(together, f"doc_id {kind}, ids array<int>" + ", decoded binary" * decoded)
    )


class TokenBytes:
    """The token-byte table: the bytes of all ids, and how many each has."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.counts = np.array([len(t) for t in tokens], np.int64)

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """Join the ids of each list with the table; an id that it lacks
        raises."""
        if lists.null_count:
            lists = lists.fill_null([])
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        if ids.size and (ids.min() < 0 or ids.max() >= self.counts.size or not self.counts[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        raw = b"".join(_ragged(self.flat, self.counts, ids[k : k + CHUNK])[0].tobytes() for k in range(0, ids.size, CHUNK))
        places = np.concatenate(([0], np.cumsum(self.counts[ids])))[ends].tolist()
        return pa.array([raw[a:b] for a, b in zip(places, places[1:])], pa.binary())


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Add ``decoded`` (binary) to rows with ``ids``: the bytes of the ids.

    The token-byte table has one row per vocabulary entry, so it is broadcast
    and joined on the executors. Null ids decode to no bytes; an id outside
    the vocabulary raises. All other columns but ``decoded`` are kept.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenBytes(shared.value)
        for batch in batches:
            names = [n for n in batch.schema.names if n != "decoded"]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), tokens.decode(batch["ids"])], [*names, "decoded"])

    kept = encoded.drop("decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, decoded binary")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    done = encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
