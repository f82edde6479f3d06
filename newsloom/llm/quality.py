"""Quality classifier: naive Bayes support vectors over n-gram indicators.

1. In how many labelled texts of either class each n-gram occurs is counted over all labelled rows, in a table of fixed
   size. The logarithm of the ratio of the two shares is the n-gram's weight in the naive Bayes sense.
2. A text is the set of its n-grams, each scaled by that ratio, as a vector of unit length. A linear model with hinge
   loss is fitted to those of a bounded sample, by dual coordinate descent, and drawn to the plain naive Bayes weights.
3. Margins of rows that a model was not fitted to calibrate the score.

N-grams are those of words (one and two), of bytes (four, with their case), and of word shapes (one to three): a shape says
which kinds of characters a word has, begins and ends with, and whether it repeats the word before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import texts as X
from newsloom.session import stored

SLOTS = 1 << 18
PIECE = 1 << 14
# The linear model is fitted to at most this many labelled rows, those with the smallest hash of their id. Its one task
# holds at most 32 KiB of each.
SAMPLE = 10_000
# An n-gram of fewer labelled texts says nothing.
LEAST_TEXTS = 4
SMOOTHING = 1.0
COST, EPOCHS, TOLERANCE = 1.0, 30, 0.01
# Weight of the fitted model against the plain naive Bayes weights.
INTERPOLATION = 0.25
FOLDS = 3
# Labels that may be broadcast to the texts; more of them are joined by a shuffle.
MAX_BROADCAST_LABELS = 500_000

_COUNT = np.dtype([("slot", "<u4"), ("low", "<u4"), ("high", "<u4")])

# Kinds of bytes: blank, small letter, capital, digit, of a multi-byte character, anything else.
_KIND = np.full(256, 5, np.int64)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 4


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """A number for each word: kinds of its first and last two bytes, kinds it has, whether it is short, and a repeat."""
    kind = _KIND[data]
    shape = (kind[starts] * 6 + kind[ends - 1]) * 6 + kind[np.maximum(ends - 2, starts)]
    for k in (1, 2, 5):
        has = np.concatenate(([0], np.cumsum(kind == k)))
        shape = shape * 2 + (has[ends] > has[starts])
    return (shape * 4 + np.minimum(ends - starts, 4) - 1) * 2 + repeats


def _runs_of(values: np.ndarray, text: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive values of one text, and their texts."""
    size = max(0, len(values) - n + 1)
    run = np.full(size, seed, np.uint64)
    for i in range(n):
        run = X.mix(run + values[i : size + i])
    whole = text[:size] == text[n - 1 : size + n - 1]
    return run[whole], text[:size][whole]


def features(words: X.Words, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different slots of each text's n-grams, and where each text's begin and the last end."""
    data, bounds = X.utf8(texts)
    n = len(bounds) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    of_byte = np.repeat(np.arange(n), np.diff(bounds))
    hashes, first = words.hashes(data, bounds)
    inside = X.Words.inside[data]
    edge = np.concatenate(([True], of_byte[1:] != of_byte[:-1], [True]))
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    of_word = np.repeat(np.arange(n), np.diff(first))
    repeats = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])))[: len(hashes)]
    shapes = _shapes(data, starts, ends, repeats).astype(np.uint64)
    found = [_runs_of(hashes, of_word, 1, 1), _runs_of(hashes, of_word, 2, 2), _runs_of(data.astype(np.uint64), of_byte, 4, 3)]
    found += [_runs_of(shapes, of_word, k, 3 + k) for k in (1, 2, 3)]
    # Texts of a slice are few, so text and slot fit 64 bits, and sorting them together sorts each text's slots.
    keys = np.sort(np.concatenate([(t.astype(np.uint64) << np.uint64(18)) | (h & np.uint64(SLOTS - 1)) for h, t in found]))
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    return (keys & np.uint64(SLOTS - 1)).astype(np.int64), np.searchsorted(keys >> np.uint64(18), np.arange(n + 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of this task's texts of each class have each slot, and how many texts there are (slot SLOTS)."""
    words, low, high = X.Words(), np.zeros(SLOTS + 1, np.int64), np.zeros(SLOTS + 1, np.int64)
    for batch in X.slices(batches):
        slots, first = features(words, X.column(batch, "text"))
        label = X.longs(batch, "label") == 1
        is_high = np.repeat(label, np.diff(first))
        high[:SLOTS] += np.bincount(slots[is_high], minlength=SLOTS)
        low[:SLOTS] += np.bincount(slots[~is_high], minlength=SLOTS)
        high[SLOTS] += label.sum()
        low[SLOTS] += (~label).sum()
    found = np.flatnonzero(low + high)
    records = np.zeros(len(found), _COUNT)
    records["slot"], records["low"], records["high"] = found, low[found], high[found]
    if len(found):
        yield X.packed(found // PIECE, records)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums by slot; a task holds the table at most."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, cell in zip(X.column(batch, "bucket").to_pylist(), X.column(batch, "records"), strict=True):
            records = np.frombuffer(cell.as_buffer(), _COUNT)
            total = sums.setdefault(piece, np.zeros((PIECE, 2), np.int64))
            total[records["slot"] - piece * PIECE] += np.column_stack((records["low"], records["high"])).astype(np.int64)
    for piece, total in sums.items():
        yield pa.record_batch({"bucket": pa.array([piece], pa.int32()), "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def class_counts(rows: DataFrame) -> np.ndarray:
    """Rows (slot, class) of counts over all of ``rows`` (text, label); the last row counts texts. 4 MiB, however many rows."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sums = X.by_bucket(rows.mapInArrow(_count, "bucket int, records binary"), parts).mapInArrow(_add, "bucket int, counts binary")
    out = np.zeros(((SLOTS // PIECE + 1) * PIECE, 2), np.int64)
    for row in sums.toLocalIterator():
        out[row.bucket * PIECE : (row.bucket + 1) * PIECE] = np.frombuffer(row.counts, "<i8").reshape(PIECE, 2)
    return out[: SLOTS + 1]


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Of each slot, the logarithm of its share of the high texts' n-grams over that of the low ones'."""
    table = counts[:SLOTS].astype(np.float64)
    known = table.sum(axis=1) >= LEAST_TEXTS
    smooth = np.where(known[:, None], table + SMOOTHING, 0.0)
    share = np.maximum(smooth, 1e-300) / np.maximum(smooth.sum(axis=0), 1e-300)
    return np.where(known, np.log(share[:, 1] / share[:, 0]), 0.0)


class Vectors:
    """Sets of slots, kept as lists of numbers or as bits, whichever is smaller."""

    def __init__(self) -> None:
        self.sets: list[np.ndarray] = []

    def add(self, slots: np.ndarray) -> None:
        if len(slots) * 4 > SLOTS // 8:
            bits = np.zeros(SLOTS, bool)
            bits[slots] = True
            self.sets.append(np.packbits(bits))
        else:
            self.sets.append(slots.astype(np.int32))

    def __getitem__(self, i: int) -> np.ndarray:
        x = self.sets[i]
        return np.flatnonzero(np.unpackbits(x)) if x.dtype == np.uint8 else x

    def __len__(self) -> int:
        return len(self.sets)


def descend(x: Vectors, y: np.ndarray, rows: np.ndarray, ratio: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: weights by slot, already times the ratio, and the bias.

    Rows of the rarer class cost more, so that both weigh the same. A row's dual value moves by its gradient, kept
    within 0 and its cost, and the weights follow at once.
    """
    square = ratio**2
    scale = np.array([1.0 / max(np.sqrt(square[x[i]].sum()), 1e-9) for i in rows])
    sign = np.where(y[rows] == 1, 1.0, -1.0)
    share = max((sign > 0).mean(), 1e-9), max((sign < 0).mean(), 1e-9)
    cost = COST * np.where(sign > 0, 0.5 / share[0], 0.5 / share[1])
    norm = np.array([(scale[k] ** 2) * square[x[i]].sum() for k, i in enumerate(rows)]) + 1.0
    weight, bias, dual = np.zeros(SLOTS), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        worst = 0.0
        for k in order.permutation(len(rows)):
            slots = x[rows[k]]
            gradient = sign[k] * (weight[slots].sum() * scale[k] + bias) - 1.0
            pull = min(gradient, 0.0) if dual[k] <= 0 else max(gradient, 0.0) if dual[k] >= cost[k] else gradient
            worst = max(worst, abs(pull))
            if pull:
                new = min(max(dual[k] - gradient / norm[k], 0.0), cost[k])
                move, dual[k] = (new - dual[k]) * sign[k], new
                weight[slots] += move * scale[k] * square[slots]
                bias += move
        if worst < TOLERANCE:
            break
    # A weight per unit of ratio is drawn to the mean size of all.
    used = ratio != 0
    plain = np.divide(weight, ratio, out=np.zeros(SLOTS), where=used)
    mean = np.abs(plain[used]).mean() if used.any() else 0.0
    return INTERPOLATION * weight + (1 - INTERPOLATION) * mean * ratio, INTERPOLATION * bias


def margins(x: Vectors, rows: np.ndarray, ratio: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    return np.array([weight[x[i]].sum() / max(np.sqrt((ratio[x[i]] ** 2).sum()), 1e-9) + bias for i in rows])


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins and labels, by Newton's method; the slope is positive."""
    high, low = (y == 1).sum(), (y != 1).sum()
    target = np.where(y == 1, (high + 1) / (high + 2), 1 / (low + 2))
    spread = max(float(margin.std()), 1e-9)
    z = np.column_stack((margin / spread, np.ones(len(margin))))
    w = np.array([1.0, np.log((high + 1) / (low + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (p - target) + 1e-3 * (w - [1.0, 0.0]))
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 1e-3) / spread, float(w[1])


@dataclass
class Model:
    """Log ratios and weights by slot, the bias, and the curve from margins to scores."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, words: X.Words, texts: pa.Array) -> np.ndarray:
        slots, first = features(words, texts)
        sums, squares = np.zeros(len(first) - 1), np.zeros(len(first) - 1)
        filled = np.flatnonzero(np.diff(first))
        if len(filled):  # each text's own sum, so equal texts get equal scores
            sums[filled] = np.add.reduceat(self.weight[slots], first[filled])
            squares[filled] = np.add.reduceat(self.ratio[slots] ** 2, first[filled])
        margin = sums / np.maximum(np.sqrt(squares), 1e-9) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def _fit(ratio):
    """Fit to the rows of one task and return the weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, x, y, ids = X.Words(), Vectors(), [], []
        for batch in X.slices(batches):
            slots, first = features(words, X.column(batch, "text"))
            y += X.column(batch, "label").to_pylist()
            ids += X.column(batch, "doc_id").to_pylist()
            for a, b in zip(first[:-1], first[1:], strict=True):
                x.add(slots[a:b])
        if not y:
            return
        order = np.array(sorted(range(len(y)), key=lambda i: (ids[i], len(x[i]), zlib.crc32(x[i]))))
        labels, r = np.array(y), ratio.value
        fold = np.empty(len(y), np.int64)
        for label in (0, 1):  # every fold has both classes, where there are enough rows
            mine = order[labels[order] == label]
            fold[mine] = np.arange(len(mine)) % FOLDS
        margin = np.zeros(len(y))
        for f in range(FOLDS):
            train, test = order[fold[order] != f], order[fold[order] == f]
            if len(test) and len(set(labels[train].tolist())) == 2:
                margin[test] = margins(x, test, r, *descend(x, labels, train, r))
        weight, bias = descend(x, labels, order, r)
        slope, offset = calibrate(margin, labels)
        yield pa.record_batch({"weight": pa.array([weight.astype("<f8").tobytes()], pa.binary()), "line": pa.array([[bias, slope, offset]], pa.list_(pa.float64()))})

    return run


def held_out(id_column: str):
    """Rows whose labels are never read: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learn from labelled rows outside the held-out ones: counts from all, the linear model from at most ``sample`` ids.

    An id that is labelled more than once has its largest label; rows that share an id all count. Other labels than 0 and
    1, null labels and null ids are not read. Without rows of both classes, all texts get the same score: the smoothed
    share of class 1, one half if there are no labels.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where(~held_out("doc_id") & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    known = stored(known.groupBy("doc_id").agg(F.max("label").alias("label")), "labels")
    rows = X.only(docs, id_column, text)
    few = known.limit(MAX_BROADCAST_LABELS + 1).count() <= MAX_BROADCAST_LABELS
    counts = class_counts(rows.join(F.broadcast(known) if few else known, "doc_id").select("text", "label"))
    low, high = counts[SLOTS].tolist()
    if not low or not high:
        share = (high + 1) / (low + high + 2)
        return Model(np.zeros(SLOTS), np.zeros(SLOTS), 0.0, 1.0, float(np.log(share / (1 - share))))
    ratio = log_ratios(counts)
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    shared = spark.sparkContext.broadcast(ratio)
    fitted = rows.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "label").repartition(1).mapInArrow(_fit(shared), "weight binary, line array<double>").first()
    if fitted is None:
        share = (high + 1) / (low + high + 2)
        return Model(ratio, np.zeros(SLOTS), 0.0, 1.0, float(np.log(share / (1 - share))))
    return Model(ratio, np.frombuffer(fitted.weight, "<f8"), *fitted.line)


def score_texts(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text", least: float = 0.3) -> DataFrame:
    """Rows (doc_id, score, predicted), one for each row of ``docs``: how likely its text has label 1.

    Whole texts are read and nothing else. A null or empty text has the score of a text without n-grams. ``predicted`` is
    1 from a score of ``least`` on. Equal texts have equal scores, whatever their ids; a null id stays null. An empty
    table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = X.Words()
        for batch in X.slices(batches):
            score = shared.value.score(words, X.column(batch, "text"))
            yield pa.record_batch({"doc_id": X.column(batch, "doc_id"), "score": pa.array(score), "predicted": pa.array((score >= least).astype(np.int32))})

    return X.only(docs, id_column, text).mapInArrow(run, "doc_id long, score double, predicted int")
