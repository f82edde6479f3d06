"""Each stage of the pipeline on its own input, and the run as a whole."""

import pytest

import corpus_pipeline as pipeline
from newsloom.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "suffix_array_dedup", "mix_to_weights", "best_fit_packing"]


def test_odd_rows(spark, odd, empty):
    """Nulls, repeated rows and clashing names go through all stages; so does an empty table."""
    for docs in (odd, empty):
        ids = None
        for name, stage in pipeline.STAGES:
            docs = stored(stage(spark, docs, ""), name)
            assert docs.columns == COLUMNS or name == "best_fit_packing"
            now = {r.doc_id for r in docs.select("doc_id").collect()}
            assert ids is None or now <= ids
            ids = now


def test_stages_against_brute_force(spark, real):
    from test_jaccard import brute as classes
    from test_suffixes import brute as repeats

    docs = spark.read.parquet(f"{real}/documents.parquet")
    stages = dict(pipeline.STAGES)
    known = stored(stages["language_id"](spark, docs, real), "test")
    assert known.count() >= 0.98 * docs.count()
    unique = stored(stages["ngram_jaccard_join"](spark, known, real), "test")
    want = {i for i, _, c in classes([(r.doc_id, r.text) for r in known.collect()]) if i == c}
    assert sorted(r.doc_id for r in unique.collect()) == sorted(want)
    cut = stored(stages["suffix_array_dedup"](spark, unique, real), "test")
    kept = {r[0]: r[4].decode(errors="ignore") for r in repeats([(r.doc_id, r.text) for r in unique.collect()])}
    assert {r.doc_id: r.text for r in cut.collect()} == kept
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    mixed = stored(stages["mix_to_weights"](spark, cut, real), "test")
    assert {r.doc_id for r in mixed.collect()} <= set(kept)
    assert all(r.text == kept[r.doc_id] for r in mixed.collect())
    packed = stages["best_fit_packing"](spark, mixed, real)
    assert packed.where("piece = 0").count() == mixed.count()


@pytest.mark.parametrize("empty_text", [None, "é" * 120])
def test_cut_texts_are_valid(spark, empty_text):
    docs = spark.createDataFrame([(1, "x" + "é" * 120, "en", "a", 1), (2, "é" * 60 + "y", "en", "a", 1), (3, empty_text, "en", "a", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = {r.doc_id: r.text for r in pipeline.suffix_array_dedup(spark, docs, "").collect()}
    assert rows[2] == "y" and "\N{REPLACEMENT CHARACTER}" not in "".join(x or "" for x in rows.values())


def test_near_copies_of_five_words(spark, real, monkeypatch):
    """Against all pairs of five-word sets; among them copies with a fifth more text or with words changed."""
    import test_jaccard

    four = test_jaccard.shingles
    docs = spark.read.parquet(f"{real}/documents.parquet").select(*COLUMNS)
    words = [f"w{i}" for i in range(400)]
    changed = [f"x{i}" if i % 47 == 20 else x for i, x in enumerate(words)]
    more = [(10**6, " ".join(words)), (10**6 + 1, " ".join(words + [f"y{i}" for i in range(80)])), (10**6 + 2, " ".join(changed))]
    docs = stored(docs.union(spark.createDataFrame([(i, x, "en", "src0", len(x)) for i, x in more], docs.schema)), "test")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert [c for _, _, c in test_jaccard.brute(more)] == [10**6, 10**6 + 1, 10**6 + 2]  # op9's contract links none of them
    monkeypatch.setattr(test_jaccard, "shingles", lambda text: four(text, 5))
    want = sorted(i for i, _, c in test_jaccard.brute(rows, percent=80) if i == c)
    assert sorted(r.doc_id for r in pipeline.ngram_jaccard_join(spark, docs, real).collect()) == want
    assert 10**6 in want and 10**6 + 1 not in want and 10**6 + 2 not in want


def test_documents_that_nothing_is_like_are_not_dealt_out(spark, monkeypatch):
    """All documents were shuffled by id to take a few away."""
    seen, by_marks = [], pipeline.by_marks

    def spied(*args):
        seen.append(by_marks(*args))
        return seen[-1]

    monkeypatch.setattr(pipeline, "by_marks", spied)
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(30)), "en", "a", 1) for i in range(300)]
    rows += [(300 + i, rows[i][1], "en", "b", 2) for i in range(3)] + [(5, "z", "en", "c", 3), (None, rows[7][1], "en", "d", 4), (8, None, "en", "e", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = pipeline.ngram_jaccard_join(spark, docs, "")
    want = [r for r in rows[:300] if r[0] not in (5, 8)] + [rows[5], rows[-2], rows[-1]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    some, alone = seen[0]
    assert some.count() < 60 and alone.count() > 240
