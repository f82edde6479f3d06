"""Packing against the tokenizer and the lower bound; mixing against its targets."""

import json
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import mixing, packing
from newsloom.llm.queries import QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return t


def test_words_of_odd_texts_have_the_tokenizer_s_ids(tokenizer):
    random.seed(1)
    parts = ["'s", "'re", "'", "'ll", "a", "Z", "é", "ß", "１", "²", "中", "\n", "\t", " ", "  ", "\x1c", "\x85", " ", "!", "_", "́", "<|endoftext|>", "😀", "'LL", "\x00"]
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(40))) for _ in range(3000)]
    tokens = packing.Tokens(TOKENIZER)
    tokens.limit = 2000  # words are forgotten and learned again
    for top in range(0, 3000, 300):
        got = tokens.encode(texts[top : top + 300])
        assert [x.tolist() for x in got] == [e.ids for e in tokenizer.encode_batch(texts[top : top + 300], add_special_tokens=False)]


@pytest.fixture(scope="module")
def loaded():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def test_added_tokens_have_the_loaded_tokenizer_s_ids(loaded):
    random.seed(4)
    parts = ["<|endoftext|>", "<|endoftext|>", "<|endoftext", "|>", "<", "'s", "a", " ", "\n", "é", "！", ""]
    texts = ["", "a<|endoftext|>b", "<|endoftext|>"] + ["".join(random.choice(parts) for _ in range(random.randrange(12))) for _ in range(1000)]
    want = [e.ids for e in loaded.encode_batch(texts, add_special_tokens=False)]
    tokens = packing.Tokens(TOKENIZER)
    assert want[1] == [64, 50256, 65]
    assert [x.tolist() for x in tokens.encode_with_added(texts)] == want
    tokens.plain = False
    assert [x.tolist() for x in tokens.encode_with_added(texts)] == want


def test_other_splitting_patterns_go_through_the_tokenizer(tmp_path):
    from tokenizers import Tokenizer

    texts = ["one two", " x", "", "a<|endoftext|>b", "It's  odd\n"]
    for change in ({"add_prefix_space": True}, {"use_regex": False}):
        file = json.loads(Path(TOKENIZER).read_text())
        file["pre_tokenizer"] |= change
        path = tmp_path / "other.json"
        path.write_text(json.dumps(file))
        tokens = packing.Tokens(str(path))
        want = [e.ids for e in Tokenizer.from_file(str(path)).encode_batch(texts, add_special_tokens=False)]
        assert not tokens.known and [x.tolist() for x in tokens.encode_with_added(texts)] == want
    assert packing.Tokens(TOKENIZER).known


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passing_on_more_bins_saves_no_sequence(spark, monkeypatch, seed):
    """Lengths above half a sequence, most of them, so that nearly all bins are underfull at every level."""
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randint(513, 700), rng.randint(513, 1000), rng.randint(1, 60)]) if rng.random() < 0.97 else rng.randint(200, 500) for _ in range(1500)]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, length long")
    found = {}
    for forward in (10**9, packing.FAN_IN * 3):  # as many as three levels can use
        monkeypatch.setattr(packing, "FORWARD", forward)
        rows = packing.pack(items, 1024, per_task=30).collect()
        found[forward] = len({r.sequence_id for r in rows})
    assert len(set(found.values())) == 1


def test_packing_added_tokens(spark, loaded):
    texts = ["a<|endoftext|>b", "<|endoftext|>" * 700, "none"]
    rows = packing.packed_sequences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), TOKENIZER, capacity=256).collect()
    check(rows, texts, loaded, 256)


def check(rows, texts, tokenizer, capacity):
    """Pieces cover each text's ids; sequences are gapless. Returns the number of sequences and the lower bound."""
    want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts)
    assert len({r.sequence_id for r in rows}) <= len(rows)
    spots, pieces = {}, {}
    for r in rows:
        spots.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for spot in spots.values():
        at = 0
        for offset, length in sorted(spot):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(map(len, want))
    assert sum(r.length for r in rows) == total
    crcs = sorted(zlib.crc32(np.asarray(ids[max(0, e - capacity) : e], "<u4")) for ids in want for e in range(len(ids), 0, -capacity))
    assert sorted(r.ids_crc32 for r in rows) == crcs
    for found in pieces.values():
        assert all(r.length == capacity for r in found if r.piece > 0)
    return len(spots), -(-total // capacity)


def test_packing_odd_rows(odd, odd_rows, tokenizer):
    rows = packing.packed_sequences(odd, TOKENIZER, capacity=256).collect()
    check(rows, [r[1] for r in odd_rows], tokenizer, 256)


def test_packing_empty(empty):
    assert packing.packed_sequences(empty, TOKENIZER).collect() == []


def test_packing_whole_table(spark, real, tokenizer):
    rows = QUERIES["op5_best_fit_packing"](spark, real).collect()
    bins, bound = check(rows, [r.text for r in spark.read.parquet(f"{real}/documents.parquet").collect()], tokenizer, 2048)
    assert bins <= bound * 1.05


def test_tree_of_groups(spark):
    random.seed(2)
    items = [(i, random.randrange(1, 1000)) for i in range(5000)]
    df = spark.createDataFrame(items, "item long, length long")
    rows = packing.pack(df, 1000, per_task=100).collect()
    spots = {}
    for r in rows:
        spots.setdefault(r.sequence_id, []).append((r.offset, dict(items)[r.item]))
    assert len(rows) == 5000
    for spot in spots.values():
        at = 0
        for offset, length in sorted(spot):
            assert offset == at
            at += length
        assert at <= 1000
    assert len(spots) <= 1.1 * sum(n for _, n in items) / 1000


def test_best_fit():
    bins, offsets, lengths = packing.best_fit([6, 5, 4, 4, 1], 10)
    assert (bins, offsets, lengths) == ([0, 1, 0, 1, 1], [0, 0, 6, 5, 9], [10, 10])


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in capped]
        level = (total - sum(cap * sizes[s] for s in capped)) / max(1e-9, sum(weight[s] for s in open_))
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 7, None: 20}, {"a": 5}, {"a": 1, "b": 1000, "c": 1000, "d": 2, "e": 50}, {"a": 0, "b": 9}])
def test_targets(spark, sizes):
    rows = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r.source: pytest.approx(r.target) for r in rows} == brute_targets(sizes)


def test_mix_odd_rows(odd, odd_rows, spark):
    rows = mixing.mix_sources(odd, carry=["source", "text", "at"]).collect()
    assert len(rows) == len(odd_rows)
    sizes = {}
    for r in rows:
        assert r.size == len((r.text or "").split()) and r.taken == r.copies * r.size and 0 <= r.copies <= 3
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = brute_targets(sizes)
    for source, size in sizes.items():
        mine = [r for r in rows if r.source == source]
        assert {r.source_size for r in mine} == {size}
        assert mine[0].target == pytest.approx(want[source])
    again = mixing.mix_sources(odd.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, rows))


def test_mix_empty(empty):
    assert mixing.mix_sources(empty).collect() == []


def test_mix_meets_targets(spark, real):
    df = QUERIES["op10_mix_sources"](spark, real)
    for r in df.groupBy("target", "source_size").agg(F.sum("taken").alias("taken"), F.max("size").alias("most")).collect():
        assert abs(r.taken - r.target) <= r.most
