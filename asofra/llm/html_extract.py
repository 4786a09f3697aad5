"""Main text by a tree-structured graphical model over the DOM.

Each node of a page is content or not. A node's own evidence is log-linear in
its tag, its class and id words and its text; a parent and child agree or
differ by a 2 x 2 potential for the child's kind. Sum-product messages, once
up and once down the tree, give each node's exact marginal. The weights
maximise the likelihood of labelled pages.

All pages of a batch are one forest, and the messages of one depth are one
numpy step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_labelled
from .common import arrow_batches, table
from .html_tree import BLOCK, RAW, Tree, joined, parse

#: Labelled pages that the default model is fitted on.
LABELLED_PAGES = 300
STEPS, RATE, RIDGE = 120, 0.08, 1e-3
SECTIONS = frozenset("nav header footer aside form article main section dialog ins menu".split())
#: Of numeric evidence: see ``_numbers``.
NUMBERS = 7
NODES_AT_ONCE = 1 << 17


@dataclass
class Model:
    columns: dict[str, int]
    weights: np.ndarray
    pairs: np.ndarray  # kind x parent label x child label


@dataclass
class Forest:
    parent: np.ndarray  # -1 for a root
    levels: list[np.ndarray]
    kind: np.ndarray
    numbers: np.ndarray
    node: np.ndarray  # with ``name``: sparse evidence
    name: list[str]


def _kind(tag: str) -> int:
    return 0 if tag == "#text" else 1 if tag in SECTIONS else 2 if tag in BLOCK else 3


def forest(trees: list[Tree]) -> Forest:
    sizes = [len(t.parent) for t in trees]
    start = np.cumsum([0, *sizes])
    parent = np.concatenate([np.array(t.parent) + s for t, s in zip(trees, start)])
    roots = start[:-1]
    parent[roots] = -1
    tags = [tag for t in trees for tag in t.tag]
    depth = [0] * parent.size
    for k, p in enumerate(parent.tolist()):
        if p >= 0:
            depth[k] = depth[p] + 1
    depth = np.array(depth)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    node, name = [], []
    for k, (tag, words) in enumerate((x for t in trees for x in zip(t.tag, t.words))):
        node += [k] * (1 + len(words))
        name.append("<" + tag)
        name += words
    texts = [x for t in trees for x in t.text]
    length = np.fromiter((len(x.strip()) for x in texts), np.float64, len(texts))
    marks = np.fromiter((x.count(". ") + x.count(",") for x in texts), np.float64, len(texts))
    ended = np.fromiter((x.rstrip()[-1:] in ".!?" and x.strip() != "" for x in texts), np.float64, len(texts))
    is_link = np.fromiter((t == "a" for t in tags), np.float64, len(tags))
    linked = is_link.copy()
    for level in levels[1:]:
        linked[level] = np.maximum(linked[level], linked[parent[level]])
    under = np.stack((length, length * linked, marks), axis=1)
    for level in levels[:0:-1]:
        np.add.at(under, parent[level], under[level])
    is_text = np.fromiter((t == "#text" for t in tags), np.float64, len(tags))
    density = under[:, 1] / np.maximum(under[:, 0], 1)
    numbers = np.stack(
        (
            np.ones(len(tags)),
            is_text * np.log1p(length) / 5,
            is_text * ended,
            is_text * linked,
            (1 - is_text) * np.log1p(under[:, 0]) / 5,
            (1 - is_text) * density,
            (1 - is_text) * np.log1p(under[:, 2]) / 3,
        ),
        axis=1,
    )
    return Forest(parent, levels, np.fromiter(map(_kind, tags), np.int64, len(tags)), numbers, np.array(node), name)


def _evidence(trees: Forest, model: Model) -> np.ndarray:
    column = np.fromiter((model.columns.get(n, -1) for n in trees.name), np.int64, len(trees.name))
    own = trees.numbers @ model.weights[:NUMBERS]
    known = column >= 0
    return own + np.bincount(trees.node[known], model.weights[column[known]], own.size)


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def messages(trees: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log beliefs of every node, and of every (parent, child) pair of labels;
    the latter is indexed by the child."""
    up = np.zeros((trees.parent.size, 2))
    up[:, 1] = _evidence(trees, model)
    sent = np.zeros_like(up)
    for level in trees.levels[:0:-1]:
        sent[level] = _sum_exp(model.pairs[trees.kind[level]] + up[level][:, None, :], 2)
        np.add.at(up, trees.parent[level], sent[level])
    belief = up.copy()
    both = np.zeros((up.shape[0], 2, 2))
    for level in trees.levels[1:]:
        rest = belief[trees.parent[level]] - sent[level]
        rest -= rest.max(axis=1, keepdims=True)
        down = rest[:, :, None] + model.pairs[trees.kind[level]]
        both[level] = down + up[level][:, None, :]
        belief[level] = up[level] + _sum_exp(down, 1)
        belief[level] -= belief[level].max(axis=1, keepdims=True)
    return belief, both


def marginals(trees: Forest, model: Model) -> np.ndarray:
    """The probability that each node is content."""
    belief, _ = messages(trees, model)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))


def _labels(trees: list[Tree]) -> np.ndarray:
    out = []
    for tree in trees:
        own: list[int] = []
        for k, gold in enumerate(tree.gold):
            own.append(gold if gold is not None else own[tree.parent[k]] if tree.parent[k] >= 0 else 0)
        out += own
    return np.array(out)


def fit(labelled: list[str]) -> Model:
    """Maximum likelihood by Adam steps on the exact gradient: evidence and
    pairs as labelled, less as expected under the model. ``labelled`` are
    pages with data-gold marks as in ``html_labelled``."""
    trees = [parse(p) for p in labelled]
    label, whole = _labels(trees), forest(trees)
    columns = {n: NUMBERS + k for k, n in enumerate(sorted(set(whole.name)))}
    model = Model(columns, np.zeros(NUMBERS + len(columns)), np.zeros((4, 2, 2)))
    column = np.array([columns[n] for n in whole.name])
    child = np.flatnonzero(whole.parent >= 0)
    seen = np.zeros((4, 2, 2))
    np.add.at(seen, (whole.kind[child], label[whole.parent[child]], label[child]), 1)
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (model.weights, model.pairs)]
    for step in range(1, STEPS + 1):
        belief, both = messages(whole, model)
        expected = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
        off = label - expected
        grad = np.concatenate((off @ whole.numbers, np.bincount(column - NUMBERS, off[whole.node], len(columns))))
        pair = np.exp(both[child] - both[child].max(axis=(1, 2), keepdims=True))
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        met = np.zeros((4, 2, 2))
        np.add.at(met, whole.kind[child], pair)
        for x, g, m in zip((model.weights, model.pairs), (grad, seen - met), moments):
            g = g / len(trees) - RIDGE * x
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            x += RATE * m[0] / (1 - 0.9**step) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return model


@lru_cache(1)
def default_model() -> Model:
    return fit(html_labelled.pages(LABELLED_PAGES))


def extract(pages: list[str], model: Model) -> list[str]:
    """The main text of each page."""
    out, held, size = [], [], 0

    def done() -> None:
        if not held:
            return
        chance = marginals(forest(held), model)
        at = 0
        for tree in held:
            own = chance[at : at + len(tree.tag)]
            at += len(tree.tag)
            hidden = [False] * len(tree.tag)
            for k in range(1, len(tree.tag)):
                hidden[k] = hidden[tree.parent[k]] or tree.tag[k] in RAW or tree.tag[k] == "head"
            out.append(joined(tree, [k for k, t in enumerate(tree.tag) if t == "#text" and own[k] >= 0.5 and not hidden[k]]))

    for page in pages:
        tree = parse(page)
        if held and size + len(tree.tag) > NODES_AT_ONCE:
            done()
            held, size = [], 0
        held.append(tree)
        size += len(tree.tag)
    done()
    return out


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text) per row of ``pages`` (page_id, url, html).

    A null html counts as empty; a page without content has the empty text.
    Null ids and addresses stay null, repeated rows give a row each, other
    columns are ignored.
    """
    spark = pages.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = extract([h or "" for h in batch["html"].to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(found, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
