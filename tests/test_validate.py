import pytest
from pyspark.sql import functions as F

from newsloom.operators import profile
from newsloom.operators import validate as V


BODY = '{"status": "success", "articles": %s}'
REASONS = {
    BODY % '[{"headline": "x"}]': None,
    BODY % '"text counts"': None,
    BODY % "7": None,
    BODY % "[]": "empty_key",
    BODY % "null": "empty_key",
    BODY % '""': "empty_key",
    BODY % "{}": "empty_key",
    BODY % "false": "empty_key",
    '{"status": "success", "other": [1]}': "missing_key",
    '{"status": "error", "articles": [1]}': "bad_status",
    '{"articles": [1]}': "bad_status",
    "-4.5": "not_an_object",
    '["success"]': "not_an_object",
    "<html>busy</html>": "string",
    '"busy"': "string",
}


@pytest.mark.parametrize("payload", REASONS)
def test_why_an_answer_is_rejected(spark, payload):
    df = spark.createDataFrame([(payload,)], "payload string")
    assert df.select(V.reject_reason(F.col("payload"), "articles")).first()[0] == REASONS[payload]


def test_answers_without_a_status(spark):
    df = spark.createDataFrame([('{"articles": ["x"]}',), ('{"articles": []}',)], "payload string")
    got = df.select(V.reject_reason(F.col("payload"), "articles", check_status=False)).collect()
    assert [r[0] for r in got] == [None, "empty_key"]


def test_columns_and_rows_must_be_there(spark):
    df = spark.createDataFrame([("btc", 3), ("eth", 4)], "coin string, rank int")
    assert V.require_columns(df, ["rank"]) is df and V.require_rows(df, "coins") is df
    with pytest.raises(KeyError, match="Missing columns"):
        V.require_columns(df, ["coin", "price"])
    with pytest.raises(ValueError):
        V.require_rows(df.where("rank > 9"), "coins")


def test_kind_profiles(spark):
    raw = ["[1, 'a']", "[]", "{'a': 1}", '{"a": true}', "x", "12", "1.5", "True", None, "[broken"]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    kinds = {r.kind: r.n for r in V.kind_profile(df, "raw").collect()}
    assert kinds == {"list": 2, "dict": 2, "string": 2, "number": 2, "bool": 1, "null": 1}
    items = {r.kind: (r.n, r.share) for r in V.element_kind_profile(df, "raw").collect()}
    assert items["null"][0] == 2 and items["number"][0] == 3 and items["string"][0] == 3
    assert sum(share for _, share in items.values()) == pytest.approx(1.0)


def test_schema_profile(spark):
    df = spark.createDataFrame(
        [(None, ["x"], 1.0, 3), ("b", ["x"], 2.0, 2), ("a", ["y"], 2.0, 1)],
        "s string, l array<string>, d double, _seq int",
    )
    got = {r.name: tuple(r)[2:] for r in profile.schema_profile(df).collect()}
    assert got == {
        "s": ("string", True, "a", "b"),
        "l": ("list", False, '["y"]', '["x"]'),
        "d": ("float64", False, "2.0", "1.0"),
    }
