"""The quality classifier: n-grams and ratios against plain counts, the linear model against its optimum, held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom.llm import quality
from newsloom.llm import texts as X


def test_features_do_not_depend_on_neighbours():
    words = X.Words()
    texts = ["The cat SAT sat.", "", "x", "naïve ### $$$ 12", "The cat SAT sat.", " \n", "a a a a"]
    slots, first = quality.features(words, pa.array(texts))
    assert len(first) == len(texts) + 1 and first[-1] == len(slots)
    for i, text in enumerate(texts):
        alone, _ = quality.features(words, pa.array([text]))
        assert slots[first[i] : first[i + 1]].tolist() == alone.tolist() == sorted(set(alone.tolist()))
    n = [b - a for a, b in zip(first[:-1], first[1:])]
    assert n[1] == n[5] == 0 and n[2] == 2  # a word and its shape
    # Distinct n-grams: words, pairs of words, four bytes, one to three shapes; collisions aside.
    t = texts[0].lower().split()
    assert n[0] <= len(set(t)) + len(t) - 1 + len(texts[0]) - 3 + 4 + 3 + 2
    shape_only, _ = quality.features(words, pa.array(["for for for"]))
    other, _ = quality.features(words, pa.array(["der der der"]))
    assert set(shape_only.tolist()) & set(other.tolist())  # a repeat is a repeat, whatever the word


def test_counts_and_ratios(spark):
    rows = [("good text here", 1), ("good words here", 1), ("BAD### text", 0), ("", 1), ("BAD### text", 0)] * 3
    counts = quality.class_counts(spark.createDataFrame(rows, "text string, label int").repartition(4))
    want = np.zeros((quality.SLOTS + 1, 2), np.int64)
    for text, label in rows:
        slots, _ = quality.features(X.Words(), pa.array([text]))
        want[slots, label] += 1
        want[quality.SLOTS, label] += 1
    assert (counts == want).all()
    known = want[:-1].sum(axis=1) >= quality.LEAST_TEXTS
    p, q = (want[:-1][known] + quality.SMOOTHING).T[::-1]
    assert np.allclose(quality.log_ratios(counts)[known], np.log((p / p.sum()) / (q / q.sum())))
    assert (quality.log_ratios(counts)[~known] == 0).all()


def test_descent_reaches_the_optimum(monkeypatch):
    """The dual value reached is that of the best weights found by a plain subgradient method on the same loss."""
    monkeypatch.setattr(quality, "EPOCHS", 2000)
    monkeypatch.setattr(quality, "TOLERANCE", 1e-6)
    monkeypatch.setattr(quality, "INTERPOLATION", 1.0)
    rng = np.random.default_rng(1)
    ratio, x, y = np.zeros(quality.SLOTS), quality.Vectors(), rng.integers(0, 2, 40)
    ratio[:30] = rng.standard_normal(30)
    sets = [np.flatnonzero(rng.random(30) < (0.3 + 0.2 * y[i] * (np.arange(30) < 15))) for i in range(40)]
    for s in sets:
        x.add(s)
    weight, bias = quality.descend(x, y, np.arange(40), ratio)
    dense = np.zeros((40, 31))
    for i, s in enumerate(sets):
        dense[i, s] = ratio[s] / np.linalg.norm(ratio[s])
    dense[:, 30] = 1
    sign = np.where(y == 1, 1.0, -1.0)
    cost = quality.COST * np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())

    def loss(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - sign * (dense @ w))).sum()

    w, best = np.zeros(31), np.inf
    for t in range(1, 60_000):
        bad = sign * (dense @ w) < 1
        w = w - (w - (cost * sign * bad) @ dense) / t
        best = min(best, loss(w))
    assert loss(np.append(weight[:30] / ratio[:30], bias)) <= best * 1.001


def test_odd_rows(spark, odd, odd_rows, empty):
    ids = [i for i in range(1, 15) if zlib.crc32(str(i).encode()) % 5]
    labels = [(i, i % 2, 1) for i in ids] + [(ids[0], 1, 1), (None, 0, 1), (2, None, 1), (3, 7, 1), (99, 0, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, text int")
    model = quality.fit(odd, table)
    got = quality.score_texts(odd, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by_text = {}
    for doc_id, text, *_ in odd_rows:
        by_text.setdefault(text or "", set()).update(r.score for r in got if r.doc_id == doc_id and sum(x[0] == doc_id for x in odd_rows) == 1)
    assert all(len(scores) <= 1 for scores in by_text.values())
    # Nothing to learn from, one class only, and nothing to score.
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score_texts(odd, quality.fit(odd, nothing)).collect()} == {0.5}
    assert {r.score > 0.5 for r in quality.score_texts(odd, quality.fit(odd, table.where("quality = 1"))).collect()} == {True}
    assert quality.score_texts(empty, model).collect() == []
    assert quality.fit(empty, table).weight.sum() == 0


def test_held_out_labels_are_not_read(spark, real):
    docs, labels = spark.read.parquet(f"{real}/documents.parquet"), spark.read.parquet(f"{real}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, turned)
    assert (a.weight == b.weight).all() and (a.slope, a.offset) == (b.slope, b.offset)


def test_held_out_accuracy(spark, real):
    path = real.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    scored = quality.score_texts(docs, quality.fit(docs, labels)).join(labels, "doc_id").where(quality.held_out("doc_id") & F.col("quality").isNotNull())
    rows = scored.select("quality", "predicted", "score").collect()
    low = [r for r in rows if r.quality == 0]
    assert len(low) >= 5 and sum(r.predicted == 0 for r in low) >= 0.9 * len(low)
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    assert pytest.approx(1, abs=0.03) == np.mean([a.score > b.score for a in rows for b in low if a.quality == 1])
