"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from newsloom.llm import variants

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs, letters=7, least=2, ratio=10, every=31):
    count = Counter()
    for doc_id, text in docs:
        for run in RUNS.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= letters and n >= least}
    found, form = {w: [] for w in words}, {}
    for a in words:
        found[a] = [b for b in words if near(a, b)]
        best = min(found[a], key=lambda b: (-words[b], b), default=None)
        if best and words[best] >= ratio * words[a]:
            form[a] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(found[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def written(seed, base, docs):
    """Texts of made-up words with edits of all kinds, in letters of one and of two bytes."""
    rng = random.Random(seed)
    letters = "abcdeorstéß×À"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(base)]
    out = []
    for i in range(docs):
        text = []
        for _ in range(60):
            w = words[min(int(rng.expovariate(0.15)), base - 1)]
            if rng.random() < 0.3:
                at, kind = rng.randrange(len(w)), rng.random()
                w = w[:at] + (rng.choice(letters) if kind < 0.7 else "") + w[at + (kind > 0.35) :]
            text.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i, rng.choice([" ", ", ", "1", "-"]).join(text)))
    return out


@pytest.mark.parametrize(("cell", "ratio"), [(1 << 15, 10), (16, 2)])
def test_against_all_pairs(spark, monkeypatch, cell, ratio):
    monkeypatch.setattr(variants, "LEAST_SAMPLE", 64)
    docs = written(3, 60, 150)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, variants.spelling_variants(df, cell=cell, ratio=ratio).collect()), key=repr)
    want = plain(docs, ratio=ratio)
    assert got == want
    assert len(want) > 300 and any(r[1] for r in want)
    assert ratio > 2 or any(r[1] and r[2] != r[1] for r in want)  # chains of forms


def test_odd_rows(spark, odd, odd_rows, empty):
    assert sorted(map(tuple, variants.spelling_variants(odd).collect()), key=repr) == plain([(r[0], r[1]) for r in odd_rows])
    assert variants.spelling_variants(empty).collect() == []
    # One very long word, its copy with an edit, and as many letters in another order.
    long = "ab" * 50_000
    docs = [(1, f"{long} {long}"), (2, f"x{long} x{long}"), (3, f"{long[::-1]} {long[::-1]}"), (4, "aaaaaaa aaaaaaa aaaaaab aaaaaab aaaaaa")]
    got = {r.word: r.n_near for r in variants.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"), every=1 << 40).collect()}
    assert got == {long: 1, "x" + long: 1, long[::-1]: 0, "aaaaaaa": 1, "aaaaaab": 1}


def test_chains_of_forms(spark):
    pointers = spark.createDataFrame([(str(i), str(i + 1)) for i in range(40)] + [("a", "b")], "word string, form string")
    assert {r.word: r.root for r in variants.roots(pointers).collect()} == {str(i): "40" for i in range(40)} | {"a": "b"}


def test_ratio_must_not_close_chains(odd):
    with pytest.raises(ValueError):
        variants.spelling_variants(odd, ratio=1)
