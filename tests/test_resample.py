import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.operators import resample as R


def day(n, hour=0):
    return dt.datetime(2024, 1, n, hour)


def table(df):
    return sorted(((r.bucket, r.ticker, r.score) for r in df.collect()), key=lambda r: (r[0], r[1]))


def scored(spark, rows):
    return spark.createDataFrame(
        rows, "datetime timestamp_ntz, ticker_names string, sentiment_score_nltk double"
    )


def test_means_with_gaps(spark):
    df = scored(spark, [
        (day(1, 5), "['A', 'B']", 0.5),
        (day(1, 6), "['A']", -0.1),
        (day(4), "['A']", 1.0),
        (day(3), "['B']", 0.2),
        (day(2), "[]", 9.0),
        (None, "['A']", 9.0),
    ])
    expected = [
        (day(1), "A", pytest.approx(0.2)), (day(1), "B", 0.5),
        (day(2), "A", None), (day(2), "B", None),
        (day(3), "A", None), (day(3), "B", 0.2),
        (day(4), "A", 1.0), (day(4), "B", None),
    ]
    assert table(R.resample_scores(df)) == expected
    filled = table(R.resample_scores(df, fill=0.0))
    assert [r[2] for r in filled] == [0.0 if e[2] is None else e[2] for e in expected]
    assert table(R.fill_scores(R.resample_scores(df), 0.0)) == filled


def test_buckets_without_any_score_do_not_stretch_the_calendar(spark):
    df = scored(spark, [
        (day(1), "['A']", None), (day(2), "['A']", 0.1), (day(3), "['A']", float("nan")),
        (day(2), "['B']", None),
    ])
    assert table(R.resample_scores(df)) == [(day(2), "A", 0.1)]


def test_hours(spark):
    df = scored(spark, [(day(1, 1), "A", 0.1), (day(1, 3), "A", 0.3)])
    got = table(R.resample_scores(df, freq="h"))
    assert got == [(day(1, 1), "A", 0.1), (day(1, 2), "A", None), (day(1, 3), "A", 0.3)]


@pytest.mark.parametrize("parsed", [False, True])
def test_nested_scores(spark, parsed):
    rows = [
        (day(1), """[{"ticker": "CRYPTO:BTC", "ticker_sentiment_score": "0.5"}, {"ticker": "", "ticker_sentiment_score": "1"}]"""),
        (day(1), """[{'ticker': 'BTC', 'ticker_sentiment_score': 0.1}, {'ticker': 'ETH', 'ticker_sentiment_score': None}]"""),
        (day(1), """[{"ticker": "BTC", "ticker_sentiment_score": "9"}, 2]"""),
        (day(1), "no list"),
        (day(1), None),
    ]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, ticker_sentiment string")
    if parsed:
        from newsloom.functions.parse import with_dicts

        df = with_dicts(df, "ticker_sentiment")
    assert table(R.resample_nested(df)) == [(day(1), "BTC", pytest.approx(0.3))]
    kept = {r[1] for r in table(R.resample_nested(df, clean_tickers=False))}
    assert kept == {"CRYPTO:BTC", "BTC"}


def test_bounds_reuse_the_shuffled_means(spark):
    df = scored(spark, [(day(1), "['A']", 0.5), (day(4), "['A']", 1.0)])
    series = R.resample_scores(df)
    series.collect()
    assert "ReusedExchange" in series._jdf.queryExecution().executedPlan().toString()


def test_pivot(spark):
    df = scored(spark, [(day(1), "['A', 'B']", 0.5), (day(3), "['B']", 0.2)])
    wide = R.pivot_scores(R.resample_scores(df))
    assert wide.columns == ["bucket", "A", "B"]
    assert sorted(map(tuple, wide.collect())) == [(day(1), 0.5, 0.5), (day(2), None, None), (day(3), None, 0.2)]
    assert R.pivot_scores(R.resample_scores(df), ["B"]).columns == ["bucket", "B"]


def test_thirty_thousand_tickers_in_blocks(spark, tmp_path):
    series = spark.range(90_000).select(
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 3).cast("int"))).alias("bucket"),
        F.concat(F.lit("T"), F.lpad((F.col("id") % 30_000).cast("string"), 5, "0")).alias("ticker"), F.col("id").cast("double").alias("score"),
    )
    paths = R.write_wide(series, str(tmp_path / "wide"), width=7500)
    assert len(paths) == 4
    for path in paths:
        table = spark.read.parquet(path)
        assert len(table.columns) == 7501 and table.count() == 3
    some = R.read_wide(spark, paths, ["T29999", "T00000", "T07500"]).orderBy("bucket").collect()
    want = {(i % 3, i % 30_000): float(i) for i in reversed(range(90_000))}  # of several scores the smallest
    assert [(r.T29999, r.T00000, r.T07500) for r in some] == [tuple(want.get((d, t)) for t in (29_999, 0, 7500)) for d in range(3)]
    with pytest.raises(KeyError):
        R.read_wide(spark, paths, ["nowhere"])
    assert R.write_wide(series.limit(0), str(tmp_path / "none")) == []
