"""Connected components: tasks contract their own edges, then alternating
large-star and small-star rounds settle what joins the tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, join_groups, written

#: Edges that one task contracts. A graph that has no more of them is settled
#: by one task; a larger one is left to the rounds.
CONTRACTED = 1 << 20

#: Each round at least halves the depth of every tree; this many rounds
#: therefore settle any graph that fits on disk.
MOST_ROUNDS = 64


def _pointed(edges: DataFrame) -> DataFrame:
    """Larger end first, no loops, no repeats."""
    return (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    )


def _to_least(edges: DataFrame) -> DataFrame:
    """Join each edge (u, v) with m, the least neighbour of u or u itself."""
    least = written(
        edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("_n")), "cc-least"
    )
    return join_groups(edges, least, ["u"], "_n")


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of each node that is not its own root; root is the least
    node that can be reached."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: u.size], at[u.size :]
    label = np.arange(nodes.size)
    while a.size:
        x, y = label[a], label[b]
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    moved = label != np.arange(nodes.size)
    return nodes[moved], nodes[label[moved]]


def _contracted(edges: DataFrame, count: int) -> DataFrame:
    """The edges of each task as stars around its least nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[b["u"].to_numpy(), b["v"].to_numpy()] for b in batches]
        if held:
            node, root = least_reachable(*(np.concatenate(x) for x in zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["u", "v"])

    return edges.coalesce(max(1, -(-count // CONTRACTED))).mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u long, v long).

    root is the least node that can be reached. Loops and repeated edges are
    harmless, but a node that has nothing but loops gets no row; rows with a
    null end are no edges. No edges: no rows. Nothing but counts and a
    checksum of the edges reaches the driver.
    """
    now = written(edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select("u", "v"), "cc-edges")
    count, before, single = now.count(), None, False
    while not single and (before is None or count <= CONTRACTED or count < 0.7 * before):
        stars = written(_contracted(now, count), "cc-stars")
        dropped(now.sparkSession, now)
        now, before, single = stars, count, count <= CONTRACTED
        count = now.count()
    if not single:
        now = _settled(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _settled(edges: DataFrame) -> DataFrame:
    """Rounds of stars until every edge points to its component's root."""
    now, seen = written(_pointed(edges), "cc-edges"), None
    for _ in range(MOST_ROUNDS):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(_pointed(large), "cc-large")
        small = _to_least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))
        )
        dropped(now.sparkSession, now)
        now = written(_pointed(small), "cc-edges")
        mark = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        if mark == seen:
            return now
        seen = mark
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
