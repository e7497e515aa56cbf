"""Connected components of an edge table: by tasks first, then by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebasin.sources.writers import stage


#: Edges that a task holds, 16 bytes each; a graph that is left with no more ends in one task.
HELD = 1 << 18


def rooted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.split(at.ravel(), 2)
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        apart = low < high
        if not apart.any():
            return nodes, nodes[label]
        x, y = x[apart], y[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]


def spanned(batches):
    """Edges ``a > b`` that connect what the edges of a task connect: a star for each
    component of up to ``HELD`` edges."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    given = lambda: pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])
    for batch in batches:
        for begin in range(0, batch.num_rows, HELD):
            part = batch.slice(begin, HELD)
            a, b = (np.concatenate([held, np.asarray(part.column(c), np.int64)]) for held, c in ((a, "a"), (b, "b")))
            nodes, label = rooted(a, b)
            a, b = nodes[nodes != label], label[nodes != label]
            if len(a) > HELD // 2:
                yield given()
                a, b = a[:0], b[:0]
    if len(a):
        yield given()


def connected(edges: DataFrame) -> DataFrame:
    """``node, label`` (the smallest node of its component) of all nodes of the
    edges ``a, b``. Tasks first reduce their edges to stars. If more than ``HELD`` edges are
    left, rounds of large and small stars follow. Each is written to the shared folder, so lineage stays
    short; the number of rounds grows with the logarithm of the longest path.
    Minima are aggregated map-side, and the joins back read plain shuffles that
    are split where a node has very many edges."""
    star = stage(edges.where("a <> b").select("a", "b").mapInArrow(spanned, "a long, b long"), "components")
    if star.count() <= HELD:
        return stage(star.coalesce(1).mapInArrow(_ended, "node long, label long"), "components")
    star = stage(star.distinct(), "components")
    before = None
    while True:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, keep_larger=True)
        star = stage(_star(large, keep_larger=False), "components")
        state = star.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    nodes = star.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(star.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _ended(batches):
    """``node, label`` of a graph that one task holds."""
    held = [(np.asarray(x.column("a"), np.int64), np.asarray(x.column("b"), np.int64)) for x in batches if x.num_rows]
    if held:
        nodes, label = rooted(*(np.concatenate(side) for side in zip(*held)))
        yield pa.record_batch([pa.array(nodes), pa.array(label)], ["node", "label"])


def _star(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """Link each node's larger (or, from ``a > b`` rows, smaller) neighbours to
    the smallest node around it."""
    least = stage(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "components-least")
    joined = edges.join(least, "a")
    if keep_larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
