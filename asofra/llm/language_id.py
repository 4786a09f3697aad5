"""Language ID: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased and everything else is a space. Each n-gram of 1 to 4
characters falls into one of BINS bins; a text is the sparse list of its bins,
and a class's score the sum of the bins' log probabilities, gathered and added
in numpy for a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, table
from .labelled import remainder, sample

BINS_LOG2 = 16
BINS = 1 << BINS_LOG2
LONGEST = 4
SMOOTHING = 0.1
#: Most rows that the classifier is fitted on.
TRAIN_ROWS = 6000
#: Characters scored at a time.
CHUNK = 1 << 18
UNKNOWN = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    classes: list[str]
    log_probs: np.ndarray  # BINS x classes, float32
    prior: np.ndarray


def _fold() -> np.ndarray:
    """For each character below 65536: its lower case, or a space."""
    return np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 32 for c in range(1 << 16)], np.uint32)


FOLD = _fold()


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of all texts, each followed by LONGEST spaces, and
    the place where each text begins. N-grams never reach the next text."""
    gap = " " * LONGEST
    raw = np.frombuffer("".join(t + gap for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    start = np.cumsum([0, *(len(t) + LONGEST for t in texts)])
    chars = FOLD[np.minimum(raw, (1 << 16) - 1)]
    if (beyond := np.flatnonzero(raw >= 1 << 16)).size:
        kinds, which = np.unique(raw[beyond], return_inverse=True)
        chars[beyond] = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 32 for c in kinds.tolist()], np.uint32)[which]
    return chars, start


def _bins(chars: np.ndarray, begin: int, end: int) -> Iterator[np.ndarray]:
    """The bins of the n-grams that start in [begin, end), length by length.
    An n-gram of another length has other bins for the same characters."""
    wide = chars[begin : end + LONGEST].astype(np.uint64)
    wide = np.concatenate((wide, np.full(LONGEST + end - begin - wide.size + 1, 32, np.uint64)))
    value = np.zeros(end - begin, np.uint64)
    for n in range(LONGEST):
        value = (value + wide[n : n + end - begin] + np.uint64(n + 1)) * MIX
        yield (value >> np.uint64(64 - BINS_LOG2)).astype(np.int64)


def _per_text(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    chars, start = _characters(texts)
    letters = np.concatenate(([0], np.cumsum(chars != 32)))
    return chars, start, letters[start[1:]] - letters[start[:-1]]


def score(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """The likeliest class of each text and its posterior probability."""
    chars, start, letters = _per_text(texts)
    total = np.tile(model.prior, (len(texts), 1))
    for begin in range(0, chars.size, CHUNK):
        end = min(begin + CHUNK, chars.size)
        first = int(np.searchsorted(start, begin, "right")) - 1
        last = int(np.searchsorted(start, end, "left"))
        cuts = np.maximum(start[first:last], begin) - begin
        for bins in _bins(chars, begin, end):
            total[first:last] += np.add.reduceat(model.log_probs[bins], cuts, axis=0, dtype=np.float64)
    best = total.argmax(axis=1)
    posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    none = letters == 0
    return [UNKNOWN if n else model.classes[b] for b, n in zip(best, none)], np.where(none, 0.0, posterior)


def fit(docs: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``most`` rows of ``docs`` (doc_id, text, lang), chosen
    by a hash of the id; an id whose rows disagree on the language is left
    out, rows without text, language or id teach nothing.

    Executors count the bins of their rows; the driver gets one count per
    class and bin. Without any row the model knows no language and answers
    ``und``.
    """
    arrow_batches(docs.sparkSession)
    known = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL")
    # the sample reads ids and languages alone, no texts
    chosen = F.broadcast(sample(known, "lang", most).select("doc_id"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                own = counts.setdefault(lang, np.zeros(BINS + 1, np.int64))
                chars, start, _ = _per_text([text])
                own[BINS] += 1
                for begin in range(0, chars.size, CHUNK):
                    for bins in _bins(chars, begin, min(begin + CHUNK, chars.size)):
                        own[:BINS] += np.bincount(bins, minlength=BINS)
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * at.size), pa.array(at), pa.array(own[at])], ["lang", "bin", "n"])

    found = (
        known.where("text IS NOT NULL").join(chosen, "doc_id", "left_semi")
        .mapInArrow(count, "lang string, bin long, n long")
        .groupBy("lang", "bin")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    classes = sorted(found["lang"].unique())
    counts = np.zeros((BINS + 1, len(classes)))
    counts[found["bin"], found["lang"].map({c: k for k, c in enumerate(classes)})] = found["n"]
    grams = counts[:BINS] + SMOOTHING
    return Model(
        classes,
        np.log(grams / grams.sum(axis=0)).astype(np.float32),
        np.log(np.maximum(counts[BINS], 1) / max(1, counts[BINS].sum())),
    )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs`` (doc_id, text).

    A null text, or one without a letter, is ``und`` with score 0. Of equally
    likely classes the first in alphabetical order is given. Rows repeated
    under one doc_id give a row each. Other columns are ignored.
    """
    arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            if shared.value.classes and texts:
                langs, scores = score(texts, shared.value)
            else:
                langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = fit(docs.where(~held_out))
    return predict(docs, model).select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "lang_pred", "score")
