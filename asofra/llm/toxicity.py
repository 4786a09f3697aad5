"""Toxicity by compression distance.

Two zstandard dictionaries are trained, on ordinary and on toxic text. A
document is cut into windows of WINDOW words, each compressed with both: what
the toxic dictionary saves over the ordinary one is the window's gain. A
logistic curve over gains, calibrated on labelled rows that the dictionaries
did not see, turns them into a score.

Toxic documents are ordinary text with toxic stretches. The trainer therefore
gets the stretches of toxic rows whose byte n-grams are LIFT times as frequent
there as in ordinary rows, and the toxic dictionary stands behind a copy of
the ordinary one, so that ordinary text compresses to the same length with
both, give or take an offset.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, table
from .labelled import labelled_texts, remainder
from .simhash import fingerprint

WINDOW = 8
LEVEL = 3
ORDINARY_BYTES, TOXIC_BYTES = 16384, 2048
#: The trainer's lengths of segments, of toxic and of ordinary text, and of n-grams.
SEGMENT, ORDINARY_SEGMENT, DMER = 24, 256, 8
#: Most labelled rows that the dictionaries and the curve are fitted on.
TRAIN_ROWS = 6000
#: The curve is calibrated on gains of rows that their dictionaries have not
#: seen: so many times, dictionaries of the other folds measure one fold.
FOLDS = 3
#: Toxic stretches are covered by byte n-grams of this length that so large a
#: share of the toxic rows (and so many at least) have, LIFT times the share
#: of the other rows.
GRAM, SHARE, LEAST, LIFT = 8, 0.03, 3, 20.0
#: Texts whose fingerprints differ in so many of 64 bits are near copies.
COPY_BITS = 12
#: The shares of windows that gain so many bytes are evidence.
HITS = (2, 3, 4, 5)
EVIDENCE = 4 + len(HITS)
THRESHOLD = 0.3
MIX = np.uint64(0x9E3779B97F4A7C15)
SPACES = bytes(32 if b in b"\t\n\v\f\r" else b for b in range(256))


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    bias: float
    center: np.ndarray
    scale: np.ndarray


def _spaced(text: bytes) -> bytes:
    """A-Z lower-cased, all white space a space, and a space at either end."""
    return b" " + text.lower().translate(SPACES) + b" "


def windows(text: bytes) -> Iterator[bytes]:
    """WINDOW words each, the last one the rest, with the spaces around them.
    The text is read whole; one window at a time is in memory beside it."""
    raw = _spaced(text)
    solid = np.frombuffer(raw, np.uint8) != 32
    begin = (np.flatnonzero(solid[1:] & ~solid[:-1])[::WINDOW]).tolist()
    for a, b in zip(begin, [*begin[1:], len(raw) - 1]):
        yield raw[a : b + 1]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    bare = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    dictionary.precompute_compress(compression_params=bare)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=bare)


def gains(texts: list[bytes], ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Per text: largest gain, mean of the three largest, mean, shares of
    HITS, and log of the number of windows; zeros without windows."""
    out = np.zeros((len(texts), EVIDENCE))
    plain, other = compressor(ordinary).compress, compressor(toxic).compress
    for k, text in enumerate(texts):
        gain = np.fromiter((len(plain(w)) - len(other(w)) for w in windows(text)), np.int32)
        if gain.size:
            top = np.sort(np.partition(gain, -3)[-3:] if gain.size > 3 else gain)
            out[k] = top[-1], top.mean(), gain.mean(), *((gain >= h).mean() for h in HITS), np.log(gain.size)
    return out


def _grams(raw: bytes) -> np.ndarray:
    """A hash of the GRAM bytes at each place."""
    if len(raw) < GRAM:
        return np.zeros(0, np.uint32)
    words = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), GRAM).copy().view(np.uint64).ravel()
    return ((words * MIX) >> np.uint64(32)).astype(np.uint32)


def _sorted_set(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if values.size else values


def _frequency(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams, sorted, and how many of the sets have each."""
    return np.unique(np.concatenate([np.zeros(0, np.uint32), *sets]), return_counts=True)


def stretches(texts: list[bytes], sets: list[np.ndarray], toxic: np.ndarray) -> list[bytes]:
    """The stretches of toxic rows that set them apart from the other rows;
    ``sets`` are the n-grams of each text."""
    n_toxic, n_plain = int(toxic.sum()), int((~toxic).sum())
    seen, rows = _frequency([s for s, t in zip(sets, toxic) if t])
    common, others = _frequency([s for s, t in zip(sets, toxic) if not t])
    at = np.minimum(np.searchsorted(common, seen), max(common.size - 1, 0))
    other = np.where(common[at] == seen, others[at], 0) if common.size else np.zeros(seen.size)
    lift = rows / max(1, n_toxic) / ((other + 0.5) / max(1, n_plain))
    telling = seen[(rows >= max(LEAST, SHARE * n_toxic)) & (lift > LIFT)]
    out = []
    for k in np.flatnonzero(toxic).tolist():
        raw = _spaced(texts[k])
        start = np.flatnonzero(np.isin(_grams(raw), telling))
        if start.size:
            cut = np.flatnonzero(np.diff(start) > GRAM)
            ends = start[np.append(cut, start.size - 1)] + GRAM
            out += [raw[a:b] for a, b in zip(start[np.append(0, cut + 1)].tolist(), ends.tolist())]
    return out


def train_dictionaries(texts: list[bytes], sets: list[np.ndarray], toxic: np.ndarray) -> tuple[bytes, bytes]:
    """The ordinary dictionary, and the toxic one behind a copy of it."""
    own = stretches(texts, sets, toxic)
    cut = [w for t, is_toxic in zip(texts, toxic) if not is_toxic for w in windows(t)]
    try:
        ordinary = zstandard.train_dictionary(ORDINARY_BYTES, cut, k=ORDINARY_SEGMENT, d=DMER, steps=1).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        ordinary = b"".join(cut)[:ORDINARY_BYTES] or b" "
    try:
        trained = zstandard.train_dictionary(TOXIC_BYTES, own, k=SEGMENT, d=DMER, steps=1).as_bytes()
    except zstandard.ZstdError:  # the same: the most frequent stretches, nearest to the end
        trained = b"".join(s for s, _ in Counter(own).most_common()[::-1])[-TOXIC_BYTES:]
    return ordinary, ordinary + trained


def calibrate(found: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Logistic weights by Newton steps with a small ridge."""
    center, scale = found.mean(axis=0), found.std(axis=0) + 1e-9
    x = np.column_stack(((found - center) / scale, np.ones(len(found))))
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(w.size)
        w -= np.linalg.solve(hessian, x.T @ (p - labels) + w)
    return w[:-1], float(w[-1]), center, scale


def without_copies(texts: list[bytes]) -> np.ndarray:
    """Which texts have no near copy before them. Stretches of a passage that
    was copied often would look as if they set its label apart."""
    found = np.array([fingerprint(t)[0] for t in texts], np.uint64)
    kept = np.zeros(len(texts), bool)
    for k in range(len(texts)):
        kept[k] = not (np.bitwise_count(found[:k][kept[:k]] ^ found[k]) <= COPY_BITS).any()
    return kept


def train(texts: list[bytes], toxic: np.ndarray) -> Model:
    """Fit on texts and whether each is toxic. Of near copies one counts.
    Without both labels the score is the share of toxic texts, one half
    without any text."""
    alone = without_copies(texts)
    texts, toxic = [t for t, a in zip(texts, alone) if a], toxic[alone]
    if toxic.all() or not toxic.any():
        share = (toxic.sum() + 0.5) / (toxic.size + 1)
        return Model(b" ", b" ", np.zeros(EVIDENCE), float(np.log(share / (1 - share))), np.zeros(EVIDENCE), np.ones(EVIDENCE))
    sets = [_sorted_set(_grams(_spaced(t))) for t in texts]
    fold, found = np.arange(len(texts)) % FOLDS, np.zeros((len(texts), EVIDENCE))
    for k in range(FOLDS):
        rest = np.flatnonzero(fold != k).tolist()
        own = train_dictionaries([texts[i] for i in rest], [sets[i] for i in rest], toxic[rest])
        found[fold == k] = gains([t for t, f in zip(texts, fold) if f == k], *own)
    return Model(*train_dictionaries(texts, sets, toxic), *calibrate(found, toxic))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAIN_ROWS) -> Model:
    """``train`` on at most ``most`` labelled rows, chosen by a hash of the
    id; the driver gets their texts, one an id."""
    rows = labelled_texts(docs, labels, label, most).toArrow()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable").tolist()
    return train([rows["text"][k].as_py().encode() for k in order], rows["label"].to_numpy()[order] == 1)


def scores(texts: list[bytes], m: Model) -> np.ndarray:
    logit = (gains(texts, m.ordinary, m.toxic) - m.center) / m.scale @ m.weights + m.bias
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of ``docs`` (doc_id, text).

    A null text counts as empty; an empty text has no windows and gets the
    curve's value at no gain. Rows repeated under one doc_id give a row each.
    Other columns are ignored.
    """
    arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores([t.as_py() or b"" for t in batch["text"]], shared.value)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind}, score double")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = fit(docs, labels.where(~held_out))
    return predict(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
