"""Links and nearest vectors against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, node long, shard int"


def odd_vectors():
    rng, rows = np.random.default_rng(4), []
    for i in range(700):
        if i % 3 and i > 5:
            base = np.asarray(rows[rng.integers(0, i)][1])
            v = base if i % 11 == 0 else base + rng.standard_normal(16) * rng.choice([0.05, 0.2, 0.3])
        else:
            v = rng.standard_normal(16)
        rows.append((i, [float(np.float32(x)) for x in v]))
    rows += [(800, None), (801, [0.0] * 16), (802, [1.0, None] + [0.0] * 14), (803, [math.nan] * 16), (804, [math.inf] + [0.0] * 15), (805, []), (806, rows[0][1][:8]), (807, rows[0][1][:8]), (None, rows[0][1]), (808, [1e30] * 16), (809, [1e-30] * 16)]
    rows += [rows[3], (4, rows[9][1])]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    rows = odd_vectors()
    return rows, spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(3)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize(("cell", "crowd"), [(1024, 4096), (64, 16)])
def test_links(table, monkeypatch, cell, crowd):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "CROWD", crowd)
    rows, df = table
    good = [i is not None and usable(v) and any(v) for i, v in rows]
    unit = [vectors.unit(np.asarray([v], float))[0] if g else None for (_, v), g in zip(rows, good, strict=True)]
    links, root = [0] * len(rows), {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if good[a] and good[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9:
                links[a] += 1
                links[b] += 1
                x, y = find(rows[a][0]), find(rows[b][0])
                root[max(x, y)] = min(x, y)
    got = vectors.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert sum(r.n_links for r in got) >= 0.95 * sum(links) and sum(r.n_links for r in got) <= sum(links)
    if cell == 1024:  # one cell: only the count can miss
        assert sum(r.n_links for r in got) >= 0.99 * sum(links)
    for r in got:
        assert r.kept == (r.vec_id is not None and r.vec_id == r.component_id)
        assert r.component_id is None if r.vec_id is None else find(r.component_id) == find(r.vec_id)
    assert sum(r.component_id == find(r.vec_id) for r in got if r.vec_id is not None) >= 0.97 * len(rows)
    assert next(r for r in got if r.vec_id == 801).n_links == 0


def test_crowded_cluster_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CROWD", 50)
    rng = np.random.default_rng(1)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.01 * rng.standard_normal(16)).tolist()) for i in range(400)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.n_links for r in got} == {399} and {r.component_id for r in got} == {0}


def test_empty(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert vectors.near_duplicates(nothing).collect() == []
    assert topk.top_k(nothing, F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize(("shard", "leaf"), [(4096, 64), (60, 4)])
def test_top_k(table, monkeypatch, shard, leaf):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "LEAF", leaf)
    rows, df = table
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    want = []
    for i, q in ints:
        if i % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, c, strict=True)), j) for j, c in ints if j != i and len(c) == len(q))[:5]
            want += [(i, n + 1, j, max(-(1 << 63), min((1 << 63) - 1, -s))) for n, (s, j) in enumerate(scores)]
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("shard", [4096, 8])
def test_top_k_of_huge_components(spark, monkeypatch, shard):
    """Finite components of any size: other rows keep their results, and huge products stop at the ends of a long."""
    monkeypatch.setattr(topk, "SHARD", shard)
    rng = np.random.default_rng(8)
    rows = [(50 * i, rng.standard_normal(4).tolist()) for i in range(6)] + [(i, (rng.standard_normal(4) * 10.0 ** rng.integers(0, 25)).tolist()) for i in range(1, 30)]
    rows += [(101, [1e306, 0.0, 0.0, 0.0]), (103, [-1e306, 1e306, 1.0, 0.0]), (400, [1.7e308, -1.7e308, 1.0, 2.0]), (450, [0.0, 0.0, 3.5, 1e160]), (451, [0.0] * 4), (500, [0.0] * 4)]

    def whole(v):
        return [int(x) * 256 if abs(x) >= 2.0**53 else math.floor(256 * x) for x in v]

    want = []
    for i, q in rows:
        if i % 50 == 0:
            scores = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(whole(q), whole(c), strict=True)))), j) for j, c in rows if j != i)
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:5])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_tree_prunes():
    """On clustered vectors, a good bound leaves most leaves unopened."""
    random.seed(1)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 8)) * 100
    v = np.floor(np.concatenate([c + rng.standard_normal((100, 8)) for c in centres]))
    tree = topk.ball_tree(v, 16)
    q = v[:5]
    score, ids, scored = topk.search(tree, np.arange(len(v)), v, q, np.full(5, -1), 3, np.full(5, -np.inf))
    want = np.sort(q @ v.T, axis=1)[:, ::-1][:, :3]
    assert (score == want).all()
    assert scored < 0.5 * 5 * len(v)
