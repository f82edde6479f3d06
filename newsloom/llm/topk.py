"""Exact top-k search by inner product: branch and bound over one ball tree per shard.

Candidates are dealt to shards of bounded size, and each shard's tree is built once and stored. Queries travel in
blocks. A block first searches one shard; the k-th scores found there go with it to all other shards, where they
prune from the start. Within a tree, nodes are taken in order of the largest inner product that they may hold for a
query of the block (q . centre + |q| * radius), and a node is only opened for the queries whose current k-th score it
may reach.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm import texts as X
from newsloom.session import stored

# Vectors of a shard, of a leaf, and queries of a block.
SHARD = 4096
LEAF = 64
BLOCK = 64

_EXACT = float(1 << 53)


def usable(vector: str) -> Column:
    """Whether a vector is not null, and holds neither null nor non-finite components."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def _saved(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _loaded(cell: pa.Scalar) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(cell.as_buffer().to_pybytes())))


def ball_tree(vectors: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Nodes (rows from ``low`` to ``high`` of ``order``, centre, radius, two children or -1), the root first."""
    order = np.arange(len(vectors))
    low, high, centre, radius, left, right = [], [], [], [], [], []
    todo = [(0, len(vectors), -1, 0)]
    while todo:
        a, b, parent, side = todo.pop()
        node = len(low)
        if parent >= 0:
            (left, right)[side][parent] = node
        rows = vectors[order[a:b]]
        middle = rows.mean(axis=0)
        far = ((rows - middle) ** 2).sum(axis=1)
        low.append(a)
        high.append(b)
        centre.append(middle)
        radius.append(np.sqrt(far.max()))
        left.append(-1)
        right.append(-1)
        if b - a > leaf and far.max() > 0:
            one = rows[far.argmax()]
            two = rows[((rows - one) ** 2).sum(axis=1).argmax()]
            order[a:b] = order[a:b][np.argsort(rows @ (two - one), kind="stable")]
            half = (a + b) // 2
            todo += [(half, b, node, 1), (a, half, node, 0)]
    return {
        "order": order, "low": np.asarray(low), "high": np.asarray(high), "centre": np.asarray(centre),
        "radius": np.asarray(radius), "left": np.asarray(left), "right": np.asarray(right),
    }


def _whole(raw: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of any finite numbers as exact integers. ``scale`` is a power of two."""
    return np.array([[int(x) * int(scale) if abs(x) >= 2.0**53 else int(np.floor(scale * x)) for x in row] for row in raw.tolist()], object).reshape(raw.shape)


def _clipped(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of exact integers; those beyond the range of a long stop at its ends."""
    return np.clip(a @ b.T, -(1 << 63), (1 << 63) - 1)


def _floors(raw: np.ndarray, scale: float) -> tuple[np.ndarray, int]:
    """floor(scale * x) over 2^shift. The shift is 0 unless squares of such numbers might overflow."""
    top = int(np.frexp(np.abs(raw).max(initial=0.0))[1]) + int(np.log2(scale))
    shift = top if top > 400 else 0
    if not shift:
        return np.floor(scale * raw), 0
    large = np.abs(raw) >= 2.0**53
    return np.where(large, np.ldexp(raw, int(np.log2(scale)) - shift), np.ldexp(np.floor(scale * np.where(large, 0.0, raw)), -shift)), shift


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles; those beyond the range of a long stop at its ends."""
    if not len(a) or not len(b) or np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < _EXACT:
        return a @ b.T
    return _clipped(_whole(a, 1), _whole(b, 1))


def search(
    tree: dict[str, np.ndarray], ids: np.ndarray, vectors: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray,
    shift: int = 0, products: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
):
    """The best ``k`` (score, id) per query with scores of at least ``floor``; also how many rows were scored.

    Vectors and queries may be given over powers of two, ``shift`` in all; ``products`` then gives the exact scores of
    some queries and rows.
    """
    n = len(q)
    exact = not shift and (not len(q) or np.abs(q).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, q.shape[1]) < _EXACT)
    kind = np.float64 if exact else object
    score = np.full((n, k), -np.inf, kind)
    best = np.full((n, k), np.iinfo(np.int64).max)
    kth = floor.astype(np.float64)
    length = np.sqrt((q**2).sum(axis=1))
    bound = q @ tree["centre"].T + np.outer(length, tree["radius"])
    bound += 1e-9 * (np.abs(bound) + np.outer(length, tree["radius"] + np.sqrt((tree["centre"] ** 2).sum(axis=1)))) + 1e-6
    # Scores stop at the ends of a long, so bounds do not go below it either.
    with np.errstate(over="ignore"):
        bound = np.maximum(np.ldexp(bound, shift), -(2.0**63))
    heap, scored = [(-bound[:, 0].max(initial=-np.inf), 0)], 0
    while heap:
        _, node = heapq.heappop(heap)
        open_ = np.flatnonzero(bound[:, node] >= kth)
        if not len(open_):
            continue
        if tree["left"][node] >= 0:
            for child in (tree["left"][node], tree["right"][node]):
                heapq.heappush(heap, (-bound[open_, child].max(), int(child)))
            continue
        rows = tree["order"][tree["low"][node] : tree["high"][node]]
        found = (products(open_, rows) if shift else _products(q[open_], vectors[rows])).astype(kind)
        scored += found.size
        names = np.broadcast_to(ids[rows], found.shape)
        found[names == own[open_, None]] = -np.inf
        both = np.concatenate((score[open_], found), axis=1)
        names = np.concatenate((best[open_], names), axis=1)
        first = np.argsort(names, axis=1, kind="stable")
        both, names = np.take_along_axis(both, first, 1), np.take_along_axis(names, first, 1)
        top = np.argsort(-both, axis=1, kind="stable")[:, :k]
        score[open_] = np.take_along_axis(both, top, 1)
        best[open_] = np.take_along_axis(names, top, 1)
        kth[open_] = np.maximum(kth[open_], score[open_, k - 1].astype(np.float64))
    return score, best, scored


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long vectors as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _grow(scale: float):
    """The tree of each shard that reaches this task, with its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            keys = list(zip(X.column(batch, "dim").to_pylist(), X.column(batch, "shard").to_pylist(), strict=True))
            for key in set(keys):
                mine = batch.filter(pa.array([x == key for x in keys]))
                held.setdefault(key, []).append((X.longs(mine, "vec_id"), _matrix(X.column(mine, "vector"))))
        for (dim, shard), parts in sorted(held.items()):
            ids, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(ids, kind="stable")
            ids, vectors = ids[order], vectors[order]
            cell = _saved(ids=ids, vectors=vectors, **ball_tree(_floors(vectors, scale)[0]))
            yield pa.record_batch({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "cell": pa.array([cell], pa.binary())})

    return run


def _blocks():
    """Queries as one cell per block; a null k-th score is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = X.column(batch, "dim").to_pylist()
            for dim in sorted(set(dims)):
                mine = batch.filter(pa.array([x == dim for x in dims]))
                for top in range(0, mine.num_rows, BLOCK):
                    part = mine.slice(top, BLOCK)
                    floor = X.column(part, "kth").to_numpy(zero_copy_only=False).astype(np.float64)
                    cell = _saved(
                        query=X.longs(part, "query"), own=X.longs(part, "vec_id"), q=_matrix(X.column(part, "vector")),
                        home=X.longs(part, "home", -1), floor=np.where(np.isnan(floor), -np.inf, floor),
                    )
                    yield pa.record_batch({"dim": pa.array([dim], pa.int32()), "cell": pa.array([cell], pa.binary())})

    return run


def _visit(k: int, skip_home: bool, scale: float):
    """Search the tree of each shard for the blocks that follow it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at, ints, up = None, None, None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                key = (X.column(batch, "dim")[i].as_py(), X.column(batch, "shard")[i].as_py())
                cell = _loaded(X.column(batch, "cell")[i])
                if not X.column(batch, "is_query")[i].as_py():
                    tree, at = cell, key
                    ints, up = _floors(tree["vectors"], scale)
                    continue
                if at != key:
                    continue
                mine = np.flatnonzero(cell["home"] != key[1]) if skip_home else np.arange(len(cell["own"]))
                raw = cell["q"][mine]
                q, more = _floors(raw, scale)
                score, best, scored = search(
                    tree, tree["ids"], ints, q, cell["own"][mine], k, cell["floor"][mine], up + more,
                    lambda asked, rows, raw=raw, tree=tree: _clipped(_whole(raw[asked], scale), _whole(tree["vectors"][rows], scale)),
                )
                row, place = np.nonzero(score.astype(np.float64) > -np.inf)
                yield pa.record_batch(
                    {
                        "query": pa.array(cell["query"][mine][row]), "query_id": pa.array(cell["own"][mine][row]),
                        "vec_id": pa.array(best[row, place]), "score": pa.array([int(x) for x in score[row, place]], pa.int64()),
                    }
                )

    return run


def top_k(
    vectors: DataFrame, queries: Column, id_column: str = "vec_id", vector: str = "embedding", k: int = 5, scale: float = 256.0
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` best candidates of each query, rank from 1 on.

    Each component x becomes floor(scale * x), x as double and ``scale`` a power of two, and a score is an integer inner
    product, exact for all finite numbers; ties go to the smaller id. Queries are the rows for which ``queries`` holds; candidates are all rows but those of the query's id.
    A query with fewer candidates has fewer rows.

    Rows with a null id or vector, or with null or non-finite components, take no part. Vectors only meet those of
    their own length. Each of several query rows with the same id has its own result; each candidate row counts. Scores
    beyond the range of a long stop at its ends. An empty table gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), queries.alias("asks")
    )
    rows = rows.where(F.col("vec_id").isNotNull() & usable("vector")).withColumn("dim", F.size("vector"))
    shards = max(1, -(-rows.count() // SHARD))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    trees = dealt.repartition(max(shards, 1), "dim", "shard").select("dim", "shard", "vec_id", "vector")
    trees = stored(trees.mapInArrow(_grow(scale), "dim int, shard int, cell binary"), "trees")
    asked = rows.where("asks").select("vec_id", "vector", "dim").withColumn("query", F.monotonically_increasing_id())
    asked = asked.withColumn("home", F.pmod(F.xxhash64("query"), F.lit(shards)).cast("int"))
    asked = stored(asked.withColumn("kth", F.lit(None).cast("double")), "queries")

    result = "query long, query_id long, vec_id long, score long"

    def visited(blocks: DataFrame, skip_home: bool) -> DataFrame:
        rows = trees.withColumn("is_query", F.lit(False)).unionByName(blocks.withColumn("is_query", F.lit(True)))
        rows = rows.repartition(max(shards, parts), "dim", "shard").sortWithinPartitions("dim", "shard", "is_query")
        return rows.mapInArrow(_visit(k, skip_home, scale), result)

    # Each query's own shard first, by blocks of queries with the same one.
    at_home = asked.repartition(parts, "dim", "home").sortWithinPartitions("dim", "home")
    home = stored(visited(at_home.mapInArrow(_home_blocks(), "dim int, shard int, cell binary"), False), "home")
    kth = home.groupBy("query").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("kth")).where(F.col("n") >= k)
    bounded = asked.drop("kth").join(kth.select("query", "kth"), "query", "left")
    blocks = bounded.repartition(parts, "query").mapInArrow(_blocks(), "dim int, cell binary")
    everywhere = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = home.union(visited(everywhere, True))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _home_blocks():
    """Blocks of queries that start in the same shard."""
    cut = _blocks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            homes = X.longs(batch, "home")
            for home in np.unique(homes):
                for block in cut(iter([batch.filter(pa.array(homes == home))])):
                    yield block.append_column("shard", pa.array([int(home)], pa.int32())).select(["dim", "shard", "cell"])

    return run


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.ints, c.ints)::BIGINT AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.ints, c.ints) DESC, c.vec_id)::INTEGER AS rank
  FROM v q JOIN v c ON q.vec_id != c.vec_id AND len(q.ints) = len(c.ints)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
