"""Vector codes against plain integer k-means."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from newsloom.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, near int, x int, part int"
CLASH = ("clash", 1, 2, 3)


def plain(rows, parts=8, entries=16, rounds=6):
    """Codes of rows (vec_id, vector, label), by the definition."""
    ok = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = next((len(v) for _, v, _ in ok if v and len(v) % parts == 0), 0)
    good, width = [r for r in ok if len(r[1]) == size], size // parts
    ints = [[math.floor(x * 4096) if abs(x) < 2**50 else int(x) * 4096 for x in v] for _, v, _ in good]
    cut = [[x[p * width : (p + 1) * width] for p in range(parts)] for x in ints]
    book = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        at = [[nearest(p, c[p])[0] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(book[p])):
                mine = [c[p] for c, a in zip(cut, at, strict=True) if a[p] == e]
                if mine:
                    book[p][e] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    out, total = [], defaultdict(int)
    for (i, _, label), c in zip(good, cut, strict=True):
        found = [nearest(p, c[p]) for p in range(parts)]
        error = min(sum(min(d, 2**63 - 1) for _, d in found), 2**63 - 1)
        total[label] += error
        out.append((i, "".join(f"{e:02x}" for e, _ in found), error, label))
    out = [(i, c, e, min(total[label], 2**63 - 1), digest) for i, c, e, label in out]
    return out + [(i, None, None, None, digest) for i, v, _ in ok if len(v) != size]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("n", [3, 300])
def test_codes(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i * 3, (rng.standard_normal(16) * rng.choice([0.1, 1.0, 5.0])).tolist(), int(rng.integers(0, 4)) or None) for i in range(n)]
    rows += [rows[0], (3, rows[2][1], 1), (None, rows[1][1], None)]  # repeated row, repeated id, null id
    rows += [(5, None, 1), (8, [None] + [0.5] * 15, 1), (11, [math.nan] * 16, 1), (14, [math.inf] + [0.0] * 15, 1), (17, [], 1), (20, [1.0] * 7, 2), (23, [1.0] * 8, 2), (26, [0.0] * 16, 2), (29, [-1e-300] * 16, 2)]
    df = spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(3)
    assert ordered(codes.vector_codes(df).collect()) == ordered(plain(rows))


def test_huge_components(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(16) * 10.0 ** rng.integers(0, 12)).tolist(), i % 2) for i in range(60)]
    rows += [(60, [1e300] * 16, 1), (61, [1e30] + [0.0] * 15, 0), (1, [-1e200] * 16, 1)]
    got = codes.vector_codes(spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA)).collect()
    assert ordered(got) == ordered(plain(rows))


def test_nothing_usable(spark):
    assert codes.vector_codes(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None, 1, *CLASH), (2, [math.nan] * 8, 1, *CLASH)]
    assert codes.vector_codes(spark.createDataFrame(rows, SCHEMA)).collect() == []
    odd = codes.vector_codes(spark.createDataFrame([(1, [1.0, 2.0], 1, *CLASH)], SCHEMA)).collect()
    assert [tuple(r)[:4] for r in odd] == [(1, None, None, None)]


def test_bounds_prune():
    """On clustered parts the pivots leave few of all distances to compute, and the result stays exact."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((16, 1, 8)) * 20
    raw = np.round((centres[rng.integers(0, 16, 500)] + rng.standard_normal((500, 1, 8)) * 0.2), 3)
    entries = [[[int(x) for x in np.floor(c[0] * 4096)] for c in centres]]
    pivots = codes.choose_pivots(entries, 4)
    values = np.floor(raw * 4096)
    entry, best, computed = codes.assign(codes.Books.of(entries, pivots), values, raw, codes.pivot_distances(values, pivots), 4096)
    every = ((values[:, 0, None, :] - np.array(entries[0])[None]) ** 2).sum(axis=2)
    assert (entry[:, 0] == every.argmin(axis=1)).all() and (best[:, 0] == every.min(axis=1)).all()
    assert computed < 0.2 * 500 * 16
