import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from newsloom.functions import parse as P


def run(spark, fn, value, kind="string"):
    return spark.createDataFrame([(value,)], f"raw {kind}").select(fn(F.col("raw"))).first()[0]


@pytest.mark.parametrize("value,missing", [(-0.0, False), (float("nan"), True), (None, True), (float("inf"), False)])
def test_missing_numbers(spark, value, missing):
    assert run(spark, lambda c: P.is_missing(c, floating=True), value, "double") is missing


def test_blank_text_is_there(spark):
    assert run(spark, P.is_missing, " ") is False
    assert run(spark, P.is_missing, None) is True


LISTS = {
    "[70, -8]": ["70", "-8"],
    "('no', 'tuple')": None,
    '["dé", "\\u0041", ""]': ["dé", "A", ""],
    "['dé', \"it's\", 'say \\'hi\\'']": ["dé", "it's", "say 'hi'"],
    "[None, False, 'None, False']": ["None", "False", "None, False"],
    "[null, false, 0.25]": ["None", "False", "0.25"],
    "['mixed', null]": None,
    "[3, 4": None,
    "  [ 'padded' ,]  ": ["padded"],
    "['tab\\x09', 'not\\\\x09']": ["tab\t", "not\\x09"],
    "[1.0, 100000.0, 1e20, 5e-7, 0.0001, 12345678.5, 1e15, 1e16, -2.5e3]": [
        "1.0", "100000.0", "1e+20", "5e-07", "0.0001", "12345678.5", "1000000000000000.0", "1e+16", "-2500.0",
    ],
    "[123456789012345678901234567890]": ["123456789012345678901234567890"],
    '["1.0", "1e20"]': ["1.0", "1e20"],
    "[]": [],
    "plain words": None,
}


@pytest.mark.parametrize("value", LISTS)
def test_lists(spark, value):
    want = LISTS[value]
    assert run(spark, P.parse_list, value) == (want or [])
    assert run(spark, P.normalize_list, value) == ([value] if want is None else want)


def test_nothing_is_an_empty_list(spark):
    assert run(spark, P.parse_list, None) == run(spark, P.normalize_list, None) == run(spark, P.safe_eval, None) == []


def test_list_columns_stay(spark):
    df = spark.createDataFrame([([7, None], None)], "numbers array<int>, nothing array<string>")
    assert P.with_lists(df, "numbers", "nothing").first() == (["7", None], [])


@pytest.mark.parametrize(
    "value,want",
    [
        ('[{"coin": "xmr", "share": 0.5}, {}]', [{"coin": "xmr", "share": "0.5"}, {}]),
        ("[{'coin': None, 'up': True}]", [{"coin": None, "up": "true"}]),
        ('[{"coin": "xmr"}, "loose"]', []),
        ("[{'open': 1}", []),
        ("[None]", []),
        ("xmr", []),
        (None, []),
    ],
)
def test_dicts(spark, value, want):
    assert run(spark, P.normalize_dicts, value) == want


@pytest.mark.parametrize(
    "value,want",
    [
        ("['xmr', 'dash']", ["xmr", "dash"]),
        ('["xmr", 2.0]', ["xmr", "2.0"]),
        ("\txmr OR dash\n", ["xmr OR dash"]),
        ('["xmr", null]', ['["xmr", null]']),  # terms are Python literals, where null is no name
        ("[true]", ["[true]"]),
        ("[True]", ["True"]),
        ("['xmr'", ["['xmr'"]),
        (None, ["None"]),
    ],
)
def test_terms(spark, value, want):
    assert run(spark, P.normalize_terms, value) == want


def test_terms_of_other_columns(spark):
    df = spark.createDataFrame([(7.5, ["xmr"], None)], "number double, list array<string>, text string")
    assert P.with_terms(df, "number").first()["number"] == ["7.5"]
    assert P.with_terms(df, "list").first()["list"] == ["xmr"]
    assert P.with_terms(df, "text", null_as_empty=True).first()["text"] == []


def test_literal_lists_only(spark):
    assert run(spark, P.safe_eval, "['dash', 9]") == ["dash", "9"]
    assert run(spark, P.safe_eval, "dash") == []
    for broken in ("['dash'", "[dash]", "[true]", '["dash", null]'):
        with pytest.raises(PySparkException):
            run(spark, P.safe_eval, broken)


def test_items_about_a_ticker(spark):
    text = '[{"ticker":"CRYPTO:BTC","relevance_score":"0.1"},{"ticker":"crypto:btc"}]'
    df = spark.createDataFrame([(text,)], "raw string").select(P.normalize_dicts(F.col("raw")).alias("i"))
    row = df.select(*P.item_columns(P.item_of(F.col("i"), "Crypto:btc"))).first()
    assert row.ticker == "CRYPTO:BTC" and row.relevance_score == "0.1" and row.ticker_sentiment_score is None
    assert df.select(P.item_of(F.col("i"), "x")).first()[0] is None
    assert df.select(P.strip_tickers(P.pluck(F.col("i"), "ticker"))).first()[0] == ["BTC", "btc"]


def test_lower_items_and_scheme(spark):
    df = spark.createDataFrame([(["A", None, "b"], "https://x.y/z", "x.y")], "l array<string>, u string, v string")
    row = df.select(P.lower_items(F.col("l")), P.strip_scheme(F.col("u")), P.strip_scheme(F.col("v"))).first()
    assert tuple(row) == (["a", "b"], "x.y/z", "x.y")


@pytest.mark.parametrize(
    "value,expected",
    [
        ("20240419T153015", dt.datetime(2024, 4, 19, 15, 30, 15)),
        ("20240419T1530", dt.datetime(2024, 4, 19, 15, 30)),
        ("2024-01-01T10:00", dt.datetime(2024, 1, 1, 10)),
        ("2024-01-01 10:00:05", dt.datetime(2024, 1, 1, 10, 0, 5)),
        ("bad", None),
        (None, None),
    ],
)
def test_parse_ts(spark, value, expected):
    assert run(spark, P.parse_ts, value) == expected


def test_parse_ts_strict(spark):
    with pytest.raises(PySparkException):
        run(spark, lambda c: P.parse_ts(c, strict=True), "bad")
