"""Vector codes: each part of a vector becomes the number of its nearest codebook entry, by exact integer k-means.

Distances are pruned as LAESA does. Each part's distances to a few fixed pivots are computed once and stored with it. In
every round, the distances of the pivots to the round's entries are known too, and the difference of the two is a lower
bound for the distance of part and entry. Entries are tried in the order of their bounds; once a bound exceeds the best
exact distance so far, the rest is pruned.

A round is one scan of the stored parts: tasks sum the parts of each entry, the sums meet by entry, and the driver holds
nothing but the codebooks. Bounds are rounded down by more than their floating-point error, and all distances, sums and
means are exact integers: of 64 bits where they fit, of any size elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm import texts as X
from newsloom.session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
PIVOTS = 4
# Pivot distances are stored with 24 bits: bounds give way by this share of what they are the difference of.
SLACK = 1e-6
# Labels whose sums may be broadcast.
MAX_BROADCAST_LABELS = 10_000
MOST = (1 << 63) - 1

_HEX = [f"{i:02x}" for i in range(256)]


def _limit(width: int) -> int:
    """Components below this, and entries below its double, have distances that fit 64 bits."""
    return 1 << int((63 - np.log2(9 * width)) // 2)


def _exact(row: np.ndarray, scale: int) -> list[int]:
    """floor(scale * x) of any finite numbers; ``scale`` is a power of two, so only huge numbers need care."""
    return [int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(scale * x)) for x in row.tolist()]


@dataclass
class Books:
    """The codebooks of all parts as exact integers, and what the pruning needs of them."""

    entries: list[list[list[int]]]  # part, entry, component
    pivots: np.ndarray  # part, pivot, component; as floating-point numbers
    small: np.ndarray  # part, entry, component; zeros for entries out of range
    fits: np.ndarray  # part, entry: whether the entry is in range
    across: np.ndarray  # part, pivot, entry: distances

    @classmethod
    def of(cls, entries: list[list[list[int]]], pivots: np.ndarray) -> Books:
        width = len(entries[0][0])
        limit = 2 * _limit(width)
        fits = np.array([[all(abs(x) < limit for x in e) for e in part] for part in entries])
        small = np.array([[e if ok else [0] * width for e, ok in zip(part, oks, strict=True)] for part, oks in zip(entries, fits, strict=True)], np.int64)
        floats = np.array(entries, object).astype(np.float64)
        with np.errstate(all="ignore"):
            across = np.sqrt(((pivots[:, :, None, :] - floats[:, None, :, :]) ** 2).sum(axis=3))
        return cls(entries, pivots, small, fits, across)


def choose_pivots(entries: list[list[list[int]]], pivots: int) -> np.ndarray:
    """Of each part's first entries, those far from each other: the first, then always the one farthest from all chosen."""
    out = []
    for part in np.array(entries, object).astype(np.float64):
        chosen, far = [0], np.full(len(part), np.inf)
        while len(chosen) < min(pivots, len(part)):
            with np.errstate(all="ignore"):
                far = np.minimum(far, np.nan_to_num(((part - part[chosen[-1]]) ** 2).sum(axis=1)))
            chosen.append(int(far.argmax()))
        out.append(part[chosen])
    return np.array(out)


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (row, part, pivot) of floored parts (row, part, component) to the pivots."""
    with np.errstate(all="ignore"):
        return np.sqrt(((parts[:, :, None, :] - pivots[None]) ** 2).sum(axis=3)).astype(np.float32)


def _bounds(near: np.ndarray, across: np.ndarray) -> np.ndarray:
    """Lower bounds (item, entry) from distances of items and of entries to the pivots; 0 where those overflow."""
    low = np.zeros((len(near), across.shape[-1]))
    with np.errstate(all="ignore"):
        for pivot in range(near.shape[1]):
            x, y = near[:, pivot, None].astype(np.float64), across[:, pivot]
            bound = np.abs(x - y) - SLACK * (x + y)
            np.maximum(low, np.where(np.isfinite(bound), bound, 0.0), out=low)
    return low


def assign(books: Books, values: np.ndarray, raw: np.ndarray, near: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Entry and squared distance of each part (row, part) and how many distances were computed.

    ``values`` (row, part, component) are floored components, ``raw`` the numbers they come from. Distances beyond 64 bits
    come back as the largest such number.
    """
    rows, parts, width = values.shape
    entries = books.small.shape[1]
    limit = _limit(width)
    part_of = np.tile(np.arange(parts), rows)
    large = (np.abs(values) >= limit).any(axis=2).ravel()
    items = np.where(large[:, None], 0.0, values.reshape(-1, width)).astype(np.int64)
    low = _bounds(near.reshape(rows * parts, -1), books.across[part_of])
    order = np.argsort(low, axis=1, kind="stable")
    best, entry = np.full(len(items), MOST), np.full(len(items), -1)
    live, computed = np.flatnonzero(~large), 0
    for turn in range(entries):
        e = order[live, turn]
        go_on = low[live, e] ** 2 <= best[live] * (1 + 1e-12)
        live, e = live[go_on], e[go_on]
        if not len(live):
            break
        ok = books.fits[part_of[live], e]
        some, e = live[ok], e[ok]
        computed += len(some)
        distance = ((items[some] - books.small[part_of[some], e]) ** 2).sum(axis=1)
        better = (distance < best[some]) | ((distance == best[some]) & (e < entry[some]))
        best[some[better]], entry[some[better]] = distance[better], e[better]
    # What an entry out of range may still be nearest to, and parts that are out of range themselves.
    odd = large | (~books.fits.all(axis=1)[part_of] & (best >= limit**2))
    for i in np.flatnonzero(odd):
        x = _exact(raw.reshape(-1, width)[i], scale)
        distances = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books.entries[part_of[i]]]
        entry[i] = min(range(len(distances)), key=distances.__getitem__)
        best[i] = min(distances[entry[i]], MOST)
    return entry.reshape(rows, parts), best.reshape(rows, parts), computed


def _read(batch: pa.RecordBatch, parts: int, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Floored and raw components (row, part, component) and pivot distances (row, part, pivot) of a batch."""
    flat = X.column(batch, "x").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    raw = flat.reshape(batch.num_rows, parts, -1)
    with np.errstate(all="ignore"):
        values = np.floor(raw * scale)
    near = np.frombuffer(b"".join(X.column(batch, "near").to_pylist()), "<f4").reshape(batch.num_rows, parts, -1)
    return values, raw, near


def _sums(books, parts: int, scale: int):
    """Count and component sums of the parts of each entry, over this task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = books.value
        _, entries, width = b.small.shape
        count, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        huge: dict[int, list[int]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            values, raw, near = _read(batch, parts, scale)
            entry, _, _ = assign(b, values, raw, near, scale)
            at = (entry + np.arange(parts) * entries).ravel()
            count += np.bincount(at, minlength=len(count))
            large = (np.abs(values) >= _limit(width)).any(axis=2).ravel()
            items = np.where(large[:, None], 0.0, values.reshape(-1, width))
            for c in range(width):  # sums below 2^53, so exact
                total[:, c] += np.bincount(at, items[:, c], len(count)).astype(np.int64)
            for i in np.flatnonzero(large):
                x = _exact(raw.reshape(-1, width)[i], scale)
                huge[at[i]] = [p + q for p, q in zip(huge.get(at[i], [0] * width), x, strict=True)]
        found = np.flatnonzero(count)
        sums = [[str(int(x) + y) for x, y in zip(total[i], huge.get(i, [0] * width), strict=True)] for i in found]
        yield pa.record_batch(
            {"slot": pa.array(found.astype(np.int32)), "n": pa.array(count[found]), "sums": pa.array(sums, pa.list_(pa.string()))}
        )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per slot: at most parts x entries of them, however many tasks sent sums."""
    found: dict[int, tuple[int, list[int]]] = {}
    for batch in batches:
        for slot, n, sums in zip(*(X.column(batch, c).to_pylist() for c in ("slot", "n", "sums")), strict=True):
            m, total = found.get(slot, (0, [0] * len(sums)))
            found[slot] = (m + n, [x + int(y) for x, y in zip(total, sums, strict=True)])
    yield pa.record_batch(
        {
            "slot": pa.array(list(found), pa.int32()),
            "n": pa.array([n for n, _ in found.values()], pa.int64()),
            "sums": pa.array([[str(x) for x in s] for _, s in found.values()], pa.list_(pa.string())),
        }
    )


def _codes(books, parts: int, scale: int):
    """The code of each row and its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            entry, best, _ = assign(books.value, *_read(batch, parts, scale), scale)
            error = [min(sum(row), MOST) for row in best.tolist()]
            yield pa.record_batch(
                {
                    "vec_id": X.column(batch, "vec_id"),
                    "label": X.column(batch, "label"),
                    "code": pa.array(["".join(_HEX[e] for e in row) for row in entry.tolist()], pa.string()),
                    "error": pa.array(error, pa.int64()),
                }
            )

    return run


def _measure(pivots, parts: int, scale: int):
    """Rows with their parts' distances to the pivots, in columns (vec_id, label, x, near)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = X.column(batch, "x").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(all="ignore"):
                values = np.floor(flat.reshape(batch.num_rows, parts, -1) * scale)
            near = pivot_distances(values, pivots).reshape(batch.num_rows, -1)
            yield batch.append_column("near", pa.array([row.astype("<f4").tobytes() for row in near], pa.binary()))

    return run


def codebook_digest(entries: list[list[list[int]]]) -> str:
    """sha256 of all components, by part, entry and place, as decimal numbers with commas between."""
    return hashlib.sha256(",".join(str(x) for part in entries for e in part for x in e).encode()).hexdigest()


def vector_codes(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS,
) -> DataFrame:
    """Rows (vec_id, code, error, label_error, codebooks_sha256), one for each usable row of ``df``.

    A component x is floor(scale * x), ``scale`` a power of two. Vectors are cut into ``parts`` equal parts. A part's
    codebook starts as that part of the ``entries`` smallest ids; each round assigns all parts to their nearest entry (of
    equal distances the first) and moves each used entry to the floored mean of its parts; then parts are assigned once
    more. ``code`` has two hex digits for each part, ``error`` is the sum of squared distances and ``label_error`` its
    sum over rows of the same label, null being one label.

    Rows whose vector is null or holds null, NaN or infinite components are left out. Vectors are as long as the one of
    smallest id whose length divides by ``parts``; rows of any other length have null code and errors. Of rows that share
    an id, that with the smallest vector comes first; null ids come last. Fewer rows than entries make smaller codebooks.
    Errors beyond 64 bits are 2^63 - 1. An empty table gives an empty result. Other columns are not read.
    """
    spark = df.sparkSession
    numbers = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), numbers.alias("x"))
    rows = rows.where(F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    size = F.size("x")
    whole = rows.where((size > 0) & (size % parts == 0))
    order = F.col("vec_id").asc_nulls_last(), F.col("x").asc()
    lead = whole.orderBy(*order).select(size.alias("n")).first()
    width = lead.n // parts if lead else 0
    usable = rows.where(size == width * parts) if lead else rows.where(F.lit(False))
    first = [r.x for r in usable.orderBy(*order).select("x").limit(entries).collect()]
    if not first:
        none = F.lit(None)
        return rows.select("vec_id", none.cast("string").alias("code"), none.cast("long").alias("error"), none.cast("long").alias("label_error"), F.lit(codebook_digest([])).alias("codebooks_sha256"))
    whole_rows = [_exact(np.asarray(x, np.float64), scale) for x in first]
    book = [[x[p * width : (p + 1) * width] for x in whole_rows] for p in range(parts)]
    fixed = choose_pivots(book, pivots)
    kind = T.StructType([*usable.schema.fields, T.StructField("near", T.BinaryType())])
    table = stored(usable.mapInArrow(_measure(fixed, parts, scale), kind), "parts")

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(Books.of(book, fixed))
        sent = table.select("x", "near").mapInArrow(_sums(shared, parts, scale), "slot int, n long, sums array<string>")
        for slot, n, sums in sent.repartition("slot").mapInArrow(_added, "slot int, n long, sums array<string>").collect():
            book[slot // len(first)][slot % len(first)] = [int(s) // n for s in sums]
        shared.unpersist()

    shared = spark.sparkContext.broadcast(Books.of(book, fixed))
    kind = T.StructType([*usable.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = stored(table.mapInArrow(_codes(shared, parts, scale), kind), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    by_label = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of")
    if by_label.limit(MAX_BROADCAST_LABELS + 1).count() <= MAX_BROADCAST_LABELS:
        by_label = F.broadcast(by_label)
    coded = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left").select("vec_id", "code", "error", "label_error")
    odd = rows.where(size != width * parts).select("vec_id", *(F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"))))
    return reduce(DataFrame.unionByName, (coded, odd)).withColumn("codebooks_sha256", F.lit(codebook_digest(book)))


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same over the table ``embeddings``, all distances computed, for vectors of one length and unique ids."""
    near = """SELECT r.vec_id, r.label, r.part, r.v, min(list_sum(list_transform(range(1, len(r.v) + 1),
        lambda i: (r.v[i] - b.v[i]) * (r.v[i] - b.v[i]))) * {entries} + b.entry) AS best
      FROM parts r JOIN book{k} b USING (part) GROUP BY ALL"""
    steps = [
        f"""parts AS MATERIALIZED (SELECT vec_id, label, p.part, list_transform(
        embedding[p.part * (len(embedding) // {parts}) + 1 : (p.part + 1) * (len(embedding) // {parts})],
        lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings, (SELECT unnest(range({parts})) AS part) p
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""book0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v
      FROM parts QUALIFY entry < {entries})""",
    ]
    for k in range(rounds):
        steps.append(f"near{k} AS MATERIALIZED ({near.format(entries=entries, k=k)})")
        steps.append(
            f"""mean{k} AS (SELECT part, entry, list(CAST(c AS BIGINT) ORDER BY i) AS v FROM (
        SELECT part, best % {entries} AS entry, i, floor(sum(v[i]) / count(*)) AS c
        FROM (SELECT part, best, v, unnest(range(1, len(v) + 1)) AS i FROM near{k}) GROUP BY ALL) GROUP BY part, entry)"""
        )
        steps.append(
            f"""book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
      FROM book{k} b LEFT JOIN mean{k} m ON m.part = b.part AND m.entry = b.entry)"""
        )
    steps.append(f"last AS MATERIALIZED ({near.format(entries=entries, k=rounds)})")
    steps.append(
        f"""coded AS (SELECT vec_id, label, string_agg(format('{{:02x}}', CAST(best % {entries} AS INTEGER)), '' ORDER BY part) AS code,
        CAST(sum(best // {entries}) AS BIGINT) AS error FROM last GROUP BY vec_id, label)"""
    )
    digest = f"(SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book{rounds})"
    return (
        "WITH "
        + ", ".join(steps)
        + f""" SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      {digest} AS codebooks_sha256 FROM coded"""
    )
