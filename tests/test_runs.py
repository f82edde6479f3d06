import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.dictionaries import MERGED_COLUMNS, SOURCE_A, SOURCE_B
from newsloom.functions.text import Lexicon
from newsloom.plans import runs
from newsloom.sources.files import read_snapshot
from newsloom.workload.fixture import hashed_terms

LEXICON = Lexicon({"good": 1.9, "bad": -2.5})
T0 = dt.datetime(2024, 1, 1, 10)


def rows_a(spark, titles, first_seq=0):
    rows = [
        (f"u{i}", title, f"Fine text {i}. It is good!", f"['{i}']", T0 + dt.timedelta(days=i), first_seq + i)
        for i, title in enumerate(titles)
    ]
    df = spark.createDataFrame(
        rows, "url string, title string, summary string, search_terms string, datetime timestamp_ntz, _seq bigint"
    )
    return df.selectExpr(
        "*", "'20240101T100000' AS time_published", "'[\"me\"]' AS authors", "'s' AS source",
        "'s.example' AS source_domain", "'[{\"topic\": \"Tech\"}]' AS topics", "0.5D AS overall_sentiment_score",
        "'x' AS overall_sentiment_label",
        "'[{\"ticker\": \"CRYPTO:BTC\", \"ticker_sentiment_score\": \"0.5\"}]' AS ticker_sentiment",
    )


def rows_b(spark, urls):
    rows = [(f"B {u} bitcoin", u, f"Other words for {u}. It is good!", i) for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "title string, link string, description string, _seq bigint")
    return df.selectExpr(
        "*", "'me' AS creator", "'2024-01-01' AS pubDate", "'s' AS source_name", "1 AS source_priority",
        "'https://s.example' AS source_url", "'[\"us\"]' AS country", "'top' AS category",
        "'bitcoin OR btc' AS search_terms", "timestamp_ntz'2024-01-05 00:00:00' AS datetime",
    )


def test_source_and_merge_runs(spark, tmp_path):
    root = str(tmp_path / "lake")
    first = runs.run_source(rows_a(spark, ["good", "bad"]), SOURCE_A, root, LEXICON)
    assert set(first) == {"clean", "clean_main", "processed", "processed_main", "resampled_D", "resampled_h"}
    series = spark.read.parquet(first["resampled_D"]).orderBy("bucket").collect()
    assert [(r.bucket.day, r.ticker) for r in series] == [(1, "BTC"), (2, "BTC")]
    runs.run_source(rows_a(spark, ["newer"]), SOURCE_A, root, LEXICON, resample=False)
    main_a = read_snapshot(spark, f"{root}/processed/{SOURCE_A}/main")
    titles = {r.url: r.title for r in main_a.collect()}
    assert titles == {"u0": "newer", "u1": "bad"}

    runs.run_source(rows_b(spark, ["u1", "u9"]), SOURCE_B, root, LEXICON, resample=False)
    main_b = read_snapshot(spark, f"{root}/processed/{SOURCE_B}/main")
    assert {r.url: (r.ticker_names, r.source_url) for r in main_b.collect()} == {
        "u1": (["BTC"], "s.example"), "u9": (["BTC"], "s.example"),
    }

    for _ in range(2):  # the second time nothing new is added
        out = runs.run_merge([main_a, main_b], root, LEXICON, encode=hashed_terms)
        merged = read_snapshot(spark, out["merged_main"])
        assert merged.columns == MERGED_COLUMNS
        got = {r.url: r for r in merged.collect()}
        assert sorted(got) == ["u0", "u1", "u9"] and merged.count() == 3
    assert got["u1"].data_source == SOURCE_A and got["u1"].title == "bad"
    assert got["u1"].description == "Fine text 1. It is good! Other words for u1."


def test_rescore_leaves_other_rows_alone(spark):
    df = spark.createDataFrame(
        [("good", None, True, 0.0, "x"), ("good", None, False, 0.0, "x")],
        "title string, description string, m boolean, sentiment_score_nltk double, sentiment_label_nltk string",
    )
    got = runs.rescore(df, "m", LEXICON).orderBy(F.desc("m")).collect()
    assert got[0].sentiment_score_nltk == pytest.approx(0.4404) and got[0].sentiment_label_nltk == "Positive"
    assert (got[1].sentiment_score_nltk, got[1].sentiment_label_nltk) == (0.0, "x")


def test_transform_without_scores(spark):
    done = runs.transform_a(rows_a(spark, ["good"]), None)
    assert "sentiment_score_nltk" not in done.columns
    row = done.first()
    assert (row.category, row.ticker_names, row.authors) == (["tech"], ["BTC"], ["me"])
    with pytest.raises(KeyError):
        runs.transform_a(rows_a(spark, ["good"]).drop("topics"), None)


def test_a_url_with_more_text_than_a_task_may_hold(spark):
    """Its descriptions are never joined before similar sentences are gone."""
    rows = [(f"u{i % 2}", f"Sentence {i % 50} is here. And one", "alpha_vantage", T0, i) for i in range(400)]
    rows += [("v", "Alone. Alone.", "newsdata", T0, 1), ("w", None, "newsdata", T0, 1), ("w", None, "newsdata", T0, 2)]
    df = spark.createDataFrame(rows, "url string, description string, data_source string, datetime timestamp_ntz, _seq long")
    df = df.withColumns({c: F.lit("x") for c in ("title",)}).withColumns({"sentiment_score_nltk": F.lit(0.0), "sentiment_label_nltk": F.lit("Neutral")})
    want, got = (
        sorted(map(tuple, runs.merge_clean(df, LEXICON, encode=hashed_terms, large_text=n).select("url", "description", "title", "datetime").collect()))
        for n in (10**6, 500)
    )
    assert got == want and len(got) == 4 and len(dict((r[0], r[1]) for r in got)["u0"]) < 2000
