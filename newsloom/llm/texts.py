"""Texts of Arrow batches as byte arrays: slices of bounded size, words, shingles, and packed records.

All functions work on whole texts. A null text is an empty one.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that a worker turns into arrays at a time; a longer text is a slice of its own.
SLICE = 1 << 18
# Rows and bytes of an Arrow batch: texts are long, and a batch is held by Spark and by the worker, more than once.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task would keep it, and an executor has several."""
    import ctypes  # here, as functions travel to workers with what their module holds

    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None) if sys.platform == "linux" else None
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def kept_in_process(name: str, make: Callable[[], object]) -> object:
    """What a worker process makes once and keeps for its later tasks; it must not change results."""
    kept = sys.modules.setdefault("newsloom_worker_state", types.ModuleType("newsloom_worker_state")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def short_batches(spark: SparkSession) -> None:
    """From now on, batches of this session have few rows and bytes. Results do not depend on it.

    Plans are run after their operator has returned, so the setting stays; it is one of the session's, not of the cluster's.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def only(df: DataFrame, id_column: str, text: str, *more: str) -> DataFrame:
    """The columns an operator reads, under the names it uses: a null text is empty, ids are long.

    Other columns of ``df`` are never read, so their names cannot clash.
    """
    short_batches(df.sparkSession)
    return df.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        *(F.col(f"`{name}`") for name in more),
    )


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``size`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def longs(batch: pa.RecordBatch, name: str, null: int = 0) -> np.ndarray:
    return pc.fill_null(column(batch, name), null).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts without nulls, and where each text starts and the last ends."""
    texts = texts.cast(pa.large_string()).cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(bounds) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def tables(seed: int, white: bytes = b" \t\n\v\f\r") -> tuple[np.ndarray, np.ndarray]:
    """For each byte: a random number that is the same for A-Z and a-z, and whether it is part of a word."""
    value = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64)
    value[65:91] = value[97:123]
    inside = np.ones(256, bool)
    inside[list(white)] = False
    return value, inside


class Words:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a slice, A-Z taken as a-z, in reading order.

    A word's hash is a polynomial in random numbers per byte, so prefix sums give the hashes of all
    words of a slice at once. ``first[i]`` is the number of the first word of text i.
    """

    value, inside = tables(7)
    base = _ODD
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            up, down = np.full(n, self.base), np.full(n, self.inverse)
            up[0] = down[0] = 1
            self.powers, self.inverses = np.cumprod(up), np.cumprod(down)

    def hashes(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
        self._grow(len(data))
        inside = self.inside[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        filled = np.flatnonzero(np.diff(bounds))
        at = bounds[:-1][filled]
        opens[at] = inside[at]
        at = bounds[1:][filled] - 1
        closes[at] = inside[at]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
        sums = np.cumsum(self.value[data] * self.powers[: len(data)])
        before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        return mix((sums[ends] - before) * self.inverses[starts]), np.searchsorted(starts, bounds)


def shingle_sets(words: Words, texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted hashes of the distinct k-word shingles of each text.

    A text of fewer words has its whole sequence as the only shingle; one without words has none.
    """
    h, first = words.hashes(*utf8(texts))
    runs = h[: max(0, len(h) - k + 1)].copy()
    for i in range(1, k):
        runs = runs * _ODD + h[i : len(h) - k + 1 + i]
    runs = mix(runs)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            found = np.sort(runs[a : b - k + 1])
            out.append(found[np.concatenate(([True], found[1:] != found[:-1]))])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for x in h[a:b]:
                whole = mix(whole * _ODD + x)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def packed(buckets: np.ndarray, records: np.ndarray, name: str = "bucket", salt: int = 0) -> pa.RecordBatch:
    """Records as one binary cell per bucket, so that a shuffle moves few rows."""
    order = np.argsort(buckets, kind="stable")
    buckets, records = buckets[order], records[order]
    cuts = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1]))) if len(buckets) else np.zeros(0, int)
    ends = np.append(cuts[1:], len(buckets))
    return pa.record_batch(
        {
            name: pa.array(buckets[cuts].astype(np.int32), pa.int32()),
            "records": pa.array([records[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
        }
    )


def unpacked(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> np.ndarray:
    """All records of the packed cells that reached this task."""
    give_back()
    found = [np.frombuffer(x.as_buffer(), kind) for b in batches for x in column(b, "records")]
    return np.concatenate(found) if found else np.zeros(0, kind)


def by_bucket(df: DataFrame, partitions: int, key: str | Column = "bucket") -> DataFrame:
    return df.repartition(partitions, key)
