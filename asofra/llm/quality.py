"""Quality classifier: supervised subword embeddings.

Every word, pair of neighbouring words and character n-gram of a text, within
a word and the spaces around it, is hashed to one of BUCKETS rows of a learned embedding matrix. A document is the mean of
its word rows plus the mean of its n-gram rows, a softmax layer reads it, and
both are trained together by stochastic gradient descent in numpy. A pair of
equal neighbours is hashed as "repeated", whatever the word.

Scoring multiplies the matrix with the softmax layer once, so that each
feature adds one number; the result is that of the full product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, table
from .labelled import labelled_texts, remainder

BUCKETS_LOG2 = 16
BUCKETS = 1 << BUCKETS_LOG2
WIDTH = 16
GRAMS = (2, 3, 4)
EPOCHS = 12
RATE = 0.5
#: Most labelled rows that the classifier is fitted on.
TRAIN_ROWS = 4000
THRESHOLD = 0.7
#: Characters hashed at a time; a longer text is hashed in pieces, which gives
#: the same features.
CHUNK = 1 << 18
MIX = np.uint64(0x9E3779B97F4A7C15)
CHARACTER = np.uint64(0x100000001B3)
SPACES = dict.fromkeys(range(9, 14), " ")


@dataclass
class Model:
    weights: np.ndarray  # one number per bucket: the embedding times the layer
    bias: float


def _bucket(value: np.ndarray, kind: int) -> np.ndarray:
    mixed = (value + np.uint64(kind)) * MIX
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * MIX) >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, each behind a space, all white space a
    space, a space at the end; and where each text begins."""
    flat = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    start = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return np.where((flat >= 9) & (flat <= 13), np.uint32(32), flat), start


def features(texts: list[str], skip: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) arrays: first of words and pairs of words, then
    of n-grams of characters. An n-gram holds no space but at its ends, so no
    feature crosses from one text into the next. The first ``skip`` characters
    of a text are the word before it: only its pair with the next word counts.
    """
    flat, start = _codes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(start))
    owner = np.append(owner, len(texts) - 1)  # the space at the end
    counted = start[:-1] + (0 if skip is None else skip + (skip > 0))
    wide = flat.astype(np.uint64)
    solid = flat != 32
    edge = np.diff(np.concatenate(([0], solid.view(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    inside = np.repeat(begin, end - begin)
    place = np.flatnonzero(solid)
    # position-weighted sum of mixed characters: a word's hash
    power = (np.arange(int((end - begin).max()) if begin.size else 0, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) * MIX
    terms = (wide[place] + np.uint64(1)) * power[place - inside]
    terms ^= terms >> np.uint64(31)
    terms *= MIX
    words = np.add.reduceat(terms, np.concatenate(([0], np.cumsum(end - begin)[:-1]))) if begin.size else np.zeros(0, np.uint64)
    own = owner[begin]
    mine = begin >= counted[own]
    same = (own[1:] == own[:-1]) & mine[1:]
    pair = np.where(words[1:] == words[:-1], np.uint64(0), words[:-1] * np.uint64(3) + words[1:])[same]
    word_part = (np.concatenate((own[mine], own[1:][same])), np.concatenate((_bucket(words[mine], 1), _bucket(pair, 2))))
    whose, what, value = [], [], wide
    inner = np.ones(wide.size, bool)
    for n in range(2, max(GRAMS) + 1):
        value = value[: wide.size - n + 1] * CHARACTER + wide[n - 1 :]
        inner = inner[: value.size]
        if n > 2:
            inner = inner & solid[n - 2 : n - 2 + value.size]
        if n in GRAMS:
            real = np.flatnonzero(inner & (solid[: value.size] | solid[n - 1 :] | (n > 2)))
            real = real[real >= counted[owner[real]]]
            whose.append(owner[real])
            what.append(_bucket(value[real], 2 + n))
    return [word_part, (np.concatenate(whose), np.concatenate(what))]


def _pieces(text: str) -> Iterator[tuple[str, int]]:
    """``text`` in pieces of at most CHUNK characters, cut where white space
    begins, each behind the word before it, and how long that word is. A
    longer word is part of one piece."""
    at, word = 0, ""
    if len(text) > CHUNK:
        text = text.translate(SPACES)
    while len(text) - at > CHUNK:
        cut = text.rfind(" ", at + 1, at + CHUNK)
        cut = cut if cut > 0 else text.find(" ", at + CHUNK)
        if cut < 0:
            break
        yield word + text[at:cut], len(word)
        held = text[at:cut].rstrip(" ")
        word, at = held[held.rfind(" ") + 1 :] or word, cut
    yield word + text[at:], len(word)


def _groups(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
    """Pieces of texts, about CHUNK characters together: the text of each
    piece, the piece, and what to skip of it."""
    whose, held, skip, size = [], [], [], 0
    for k, text in enumerate(texts):
        for piece, before in _pieces(text):
            if held and size + len(piece) > CHUNK:
                yield np.array(whose), held, np.array(skip)
                whose, held, skip, size = [], [], [], 0
            whose.append(k)
            held.append(piece)
            skip.append(before)
            size += len(piece)
    if held:
        yield np.array(whose), held, np.array(skip)


def scores(texts: list[str], model: Model) -> np.ndarray:
    total, count = np.zeros((2, len(texts))), np.zeros((2, len(texts)))
    for whose, group, skip in _groups(texts):
        for kind, (owner, bucket) in enumerate(features(group, skip)):
            np.add.at(total[kind], whose, np.bincount(owner, model.weights[bucket], len(group)))
            np.add.at(count[kind], whose, np.bincount(owner, minlength=len(group)))
    logit = model.bias + (total / np.maximum(count, 1)).sum(axis=0)
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 0) -> Model:
    """rows: buckets and their weights of each document."""
    rng = np.random.default_rng(seed)
    table_ = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    layer, bias = np.zeros((WIDTH, 2)), np.zeros(2)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            bucket, weight = rows[k]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = weight @ table_[bucket]
            logit = hidden @ layer + bias
            grad = np.exp(logit - logit.max())
            grad /= grad.sum()
            grad[labels[k]] -= 1
            back = layer @ grad
            layer -= rate * np.outer(hidden, grad)
            bias -= rate * grad
            # each bucket stands once in a row
            table_[bucket] -= rate * np.outer(weight, back) * STEP_UP
    return Model((table_ @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


#: A feature is a small share of its document; its row moves by so much more.
STEP_UP = 20.0


def _row(text: str) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros((2, BUCKETS))
    for _, group, skip in _groups([text]):
        for kind, (_, bucket) in enumerate(features(group, skip)):
            counts[kind] += np.bincount(bucket, minlength=BUCKETS)
    weight = (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).sum(axis=0)
    bucket = np.flatnonzero(weight)
    return bucket, weight[bucket]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``most`` labelled rows, chosen by a hash of the id.

    The driver gets the hashed features of those rows, one an id, no texts. A
    null text counts as empty. Without any labelled row every score is one
    half.
    """
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], batch["label"],
                    pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32())),
                ],
                ["doc_id", "label", "bucket", "weight"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = labelled_texts(docs, labels, label, most).select("doc_id", "text", "label")
    found = chosen.mapInArrow(run, f"doc_id {kind}, label int, bucket array<int>, weight array<float>").toArrow()
    order = np.argsort(found["doc_id"].to_numpy(), kind="stable")
    bucket, weight = found["bucket"], found["weight"]
    rows = [(bucket[k].values.to_numpy(), weight[k].values.to_numpy()) for k in order.tolist()]
    return train(rows, found["label"].to_numpy()[order].astype(np.int64))


def scorer(spark: SparkSession, model: Model):
    """A vectorised function from a text column to its score."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(scores([t or "" for t in text], shared.value))

    return score


def scored(docs: DataFrame, model: Model) -> Column:
    """The score column of ``docs`` by its column text; a null text counts as
    empty, and an empty text has the score of the bias alone."""
    arrow_batches(docs.sparkSession)
    return scorer(docs.sparkSession, model)(F.col("text"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their
    columns; repeated rows share their fate."""
    return docs.where(scored(docs, model) >= threshold)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = fit(docs, labels.where(~held_out))
    return docs.select(
        "doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), scored(docs, model).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
