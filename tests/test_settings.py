"""Results that must not depend on session settings."""

from pathlib import Path

import pytest

from newsloom.operators import semantic
from newsloom.workload.fixture import hashed_terms
from newsloom.workload.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data here")
@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("partitions", [1, 4, 8, 200])
def test_file_counts(spark, partitions, adaptive):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        got = {r.compression: r.loaded_files for r in QUERIES["folder_summary"](spark, DATA).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got == {".gz": 4, "uncompressed": 3}


def test_rows_without_keys_survive_both_paths(spark):
    text = "One fine day. Another day. One fine day."
    rows = [(None, text, True), ("u", text, True), ("u", text + " More.", True), (None, None, None)]
    df = spark.createDataFrame(rows, "url string, description string, was_merged boolean")
    want = sorted(map(str, semantic.semantic_clean(df, encode=hashed_terms).collect()))
    assert sorted(map(str, semantic.semantic_clean(df, whole=2, block=2, encode=hashed_terms).collect())) == want and len(want) == 4


def test_each_sentence_is_encoded_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def encode(sentences):
        seen.add(len(sentences))
        return hashed_terms(sentences)

    df = spark.createDataFrame([(f"u{i}", "A one. B two. C three.", True) for i in range(40)], "url string, description string, was_merged boolean")
    assert semantic.semantic_clean(df, encode=encode).count() == 40
    assert seen.value in (0, 120)
    semantic.semantic_clean(df, encode=encode).collect()
    assert seen.value in (120, 240)
