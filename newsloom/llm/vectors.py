"""Near-duplicate vectors by collision counting over sorted one-dimensional projections.

A pair at the cosine threshold is close in most of many random projections, and a pair of unrelated vectors is not. So
for each query vector, a window is centred on its place in each sorted projection, the vectors in the window collide
with it, and pairs with enough collisions over all projections are verified by their cosine. Window and count are
calibrated by the normal distribution of a pair's distance on a random line, so that a pair at the threshold passes
with probability ``RECALL``.

Windows hold a fixed share of all vectors, so counting over all of them would be quadratic. The sorted axis is therefore
cut: in each of several tables, the signs of a few further projections choose a cell, and windows are scanned within
cells. The number of signs grows with the logarithm of the number of vectors, so cells keep their size, and the number
of tables follows from the probability that a pair at the threshold shares a cell. A pair that meets in several tables
counts in the first. Cells that stay large (a crowd of similar vectors) are cut into blocks, and each pair of blocks is
a task of its own. Tasks return sums and spanning trees, never pairs.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import texts as X
from newsloom.llm.components import components
from newsloom.llm.topk import usable
from newsloom.session import stored

RECALL = 0.98
# Vectors that a cell is to hold, and that a block of a larger cell holds.
CELL = 1024
CROWD = 4096
PROJECTIONS = 24
# Half a window is this many standard deviations of a threshold pair's distance, in this many steps of a byte.
REACH = 1.5
STEPS = 16
# Rows and columns compared at a time.
TILE = 512


class Plan:
    """What the search does for ``n`` vectors and a threshold."""

    def __init__(self, n: int, threshold: float) -> None:
        angle = math.acos(threshold)
        self.threshold = threshold
        self.signs = max(0, math.ceil(math.log2(max(1, n) / CELL)))
        together = (1 - angle / math.pi) ** self.signs
        self.tables = 1 if together >= 1 else math.ceil(math.log((1 - RECALL) / 2) / math.log(1 - together))
        # Distance of a threshold pair on a line with standard normal coefficients.
        self.spread = math.sqrt(2 - 2 * threshold)
        hit = 2 * NormalDist().cdf(REACH) - 1
        miss, self.count = 0.0, 0
        while True:  # the largest count that a threshold pair misses with at most (1 - RECALL) / 2
            miss += math.comb(PROJECTIONS, self.count) * hit**self.count * (1 - hit) ** (PROJECTIONS - self.count)
            if miss > (1 - RECALL) / 2:
                break
            self.count += 1

    def lines(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """The directions of the signs, and those of the counted projections."""
        random = np.random.default_rng(1000 + dim)
        drawn = random.standard_normal((self.tables * self.signs + PROJECTIONS, dim))
        return drawn[: self.tables * self.signs], drawn[self.tables * self.signs :]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _project(plan: Plan):
    """The cell of each vector in each table, and its quantised projections."""

    def run(batches):
        for batch in batches:
            dims = X.longs(batch, "dim")
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                rows = X.column(part, "vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                signs, lines = plan.lines(int(dim))
                u = unit(rows)
                bits = (u @ signs.T > 0).reshape(len(u), plan.tables, plan.signs)
                cells = (bits << np.arange(plan.signs)).sum(axis=2, dtype=np.int64).astype("<i4")
                # Steps wrap around a byte: that can only add collisions.
                places = np.floor(u @ lines.T * (STEPS / (REACH * plan.spread))).astype(np.int64).astype(np.uint8)
                yield pa.record_batch(
                    {
                        "node": X.column(part, "node"), "weight": X.column(part, "weight"), "dim": X.column(part, "dim"),
                        "vector": pa.array([r.tobytes() for r in rows.astype("<f8")], pa.binary()),
                        "cells": pa.array([r.tobytes() for r in cells], pa.binary()),
                        "places": pa.array([r.tobytes() for r in places], pa.binary()),
                        "cell": pa.array(list(cells), pa.list_(pa.int32())),
                    }
                )

    return run


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Give linked rows the smaller label, until labels are roots."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def _count_collisions(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """In how many projections each row of ``q`` lies in the window centred on each row of ``p``."""
    out = np.zeros((len(p), len(q)), np.uint8)
    for i in range(p.shape[1]):
        low = p[:, i, None] - np.uint8(STEPS + 1)
        out += (q[None, :, i] - low) <= np.uint8(2 * STEPS + 2)
    return out


def _compare(plan: Plan):
    """Links within one cell, or between two blocks of one: sums by vector, and a spanning forest."""

    def run(group: pa.Table) -> pa.Table:
        table, low, high = (group[c][0].as_py() for c in ("table", "low", "high"))
        stack = lambda name, kind: np.frombuffer(b"".join(group[name].to_pylist()), kind).reshape(group.num_rows, -1)
        node, weight, block = (group[c].to_numpy() for c in ("node", "weight", "block"))
        vectors, cells, places = unit(stack("vector", "<f8")), stack("cells", "<i4")[:, :table], stack("places", np.uint8)
        order = np.lexsort((node, places[:, 0], block))  # by the first projection within a block
        node, weight, block = node[order], weight[order], block[order]
        vectors, cells, places = vectors[order], cells[order], places[order]
        links, labels = np.zeros(len(node), np.int64), np.arange(len(node))
        split = int(np.searchsorted(block, low, "right"))
        rows, columns = ((0, split), (split, len(node))) if low != high else ((0, len(node)), (0, len(node)))
        for r in range(*rows, TILE):
            r_end = min(r + TILE, rows[1])
            for c in range(max(columns[0], r) if low == high else columns[0], columns[1], TILE):
                c_end = min(c + TILE, columns[1])
                near = _count_collisions(places[r:r_end], places[c:c_end]) >= plan.count
                if r == c:
                    near = np.triu(near, 1)
                a, b = np.nonzero(near)
                if not len(a):
                    continue
                if table:  # counted in an earlier table?
                    new = (cells[r + a] != cells[c + b]).all(axis=1)
                    a, b = a[new], b[new]
                if len(a) * 16 > near.size:
                    good = (vectors[r:r_end] @ vectors[c:c_end].T)[a, b] >= plan.threshold
                else:
                    good = np.einsum("ij,ij->i", vectors[r + a], vectors[c + b]) >= plan.threshold
                a, b = r + a[good], c + b[good]
                links += np.bincount(a, weight[b], len(node)).astype(np.int64) + np.bincount(b, weight[a], len(node)).astype(np.int64)
                labels = join_labels(labels, a, b)
        seen = np.flatnonzero(links)
        return pa.table({"a": pa.array(node[seen]), "b": pa.array(node[labels[seen]]), "n": pa.array(links[seen])})

    return run


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", threshold: float = 0.9
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of ``vectors``.

    Two vectors link when their cosine, in double precision, is at least ``threshold``. ``n_links`` counts the other
    vectors linked directly, ``component_id`` is the smallest id reachable by links, itself included, and ``kept`` is
    whether that is the vector's own. Links below the threshold are never made; of those at the threshold, about
    ``RECALL`` are found, and nearly all of closer ones. Equal vectors are one until the end, and their links exact.

    A vector that is null, empty or zero, or holds null or non-finite components, links with nothing, as does a row
    with a null id, whose component is null. Vectors only link with those of their own length. Rows that repeat an id
    are vectors of their own that share a component. An empty table gives an empty result. Other columns are not read.
    """
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")
    )
    good = F.col("vec_id").isNotNull() & usable("vector") & F.exists("vector", lambda x: x != 0)
    # The first id of equal vectors stands for them. A repeated id ties its vectors together.
    classes = rows.where(good).groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    named = classes.withColumn("dim", F.size("vector"))
    plan = Plan(rows.count(), threshold)
    schema = "node long, weight long, dim int, vector binary, cells binary, places binary, cell array<int>"
    # Nodes are told apart by a number of their own, as one id may stand for several vectors.
    nodes = stored(named.select(F.monotonically_increasing_id().alias("number"), "node", "weight", "dim", "vector"), "nodes")
    projected = stored(nodes.select(F.col("number").alias("node"), "weight", "dim", "vector").mapInArrow(_project(plan), schema), "projected")
    entries = projected.select("node", "weight", "dim", "vector", "cells", "places", F.posexplode("cell").alias("table", "cell"))
    key = ["dim", "table", "cell"]
    sizes = projected.select("dim", F.posexplode("cell").alias("table", "cell")).groupBy(*key).count().where("count > 1")
    sizes = stored(sizes.withColumn("blocks", F.ceil(F.col("count") / CROWD).cast("int")).drop("count"), "cells")
    dealt = entries.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("blocks", "other")
    found = dealt.groupBy(*key, "low", "high").applyInArrow(_compare(plan), "a long, b long, n long")
    found = stored(found, "links")
    links = found.groupBy(F.col("a").alias("number")).agg(F.sum("n").alias("n"))
    ends = nodes.select("number", "node")
    edges = found.where("a != b").select("a", "b")
    edges = edges.join(ends.select(F.col("number").alias("a"), F.col("node").alias("x")), "a")
    edges = edges.join(ends.select(F.col("number").alias("b"), F.col("node").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    member = rows.where(good).join(nodes.select("vector", "node", "number", "weight"), "vector").select("vec_id", "node", "number", "weight")
    member = stored(member, "members")
    labels = components(edges.union(member.select("vec_id", "node").where("vec_id != node")))
    member = member.join(links, "number", "left").join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    member = member.select(
        "vec_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    rest = rows.where(~good | F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    of_id = member.groupBy("vec_id").agg(F.min("component_id").alias("c"))
    rest = rest.join(of_id, "vec_id", "left").select("vec_id", "n_links", F.coalesce("c", "vec_id").alias("component_id"))
    return member.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
