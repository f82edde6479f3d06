import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import merge as M

T0 = dt.datetime(2024, 1, 1)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_union_checks_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2, 0)], "b string, a int, c int")
    assert rows_of(M.union_sources([a, b], ["a", "b"]), "a", "b") == [(1, "x"), (2, "y")]
    with pytest.raises(KeyError):
        M.union_sources([a, b])
    with pytest.raises(KeyError):
        M.union_sources([b, a], ["a", "c"])
    with pytest.raises(ValueError):
        M.union_sources([])


def test_keep_first_counts_null_keys_as_one(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 4, "z"), (None, 3, "w")], "k string, _seq int, v string")
    assert rows_of(M.keep_first(df, ["k"]), "k", "v") == [("a", "y"), (None, "w")]


def test_keep_first_limits_on_the_map_side(spark):
    df = spark.createDataFrame([("a", 2, "x")], "k string, _seq int, v string")
    assert "WindowGroupLimit" in M.keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()


def test_term_union_keeps_the_first_row_with_its_nulls(spark):
    df = spark.createDataFrame(
        [("u", None, "['b', 'a']", 1), ("u", "later", "c", 2), ("v", "x", None, 3), (None, "gone", "d", 4)],
        "url string, title string, search_terms string, _seq int",
    )
    assert rows_of(M.term_union(df), "url", "title", "search_terms") == [
        ("u", None, ["a", "b", "c"]), ("v", "x", ["None"]),
    ]
    assert rows_of(M.term_union(df, null_as_empty=True).where("url = 'v'"), "search_terms") == [([],)]


def news(spark, rows):
    return spark.createDataFrame(
        rows, "url string, data_source string, title string, description string, datetime timestamp_ntz, _seq bigint"
    )


def test_best_row_takes_each_column_from_the_best_source_that_has_it(spark):
    df = news(spark, [
        ("u", "newsdata", "B", "second", T0, 1),
        ("u", "alpha_vantage", None, "first", T0, 2),
        ("u", "elsewhere", "E", None, None, 0),
        ("v", "newsdata", None, None, None, 3),
        (None, "newsdata", "n", "n", T0, 4),
    ])
    got = rows_of(M.best_row_merge(df), "url", "data_source", "title", "description", "datetime", "was_merged")
    assert got == [
        ("u", "alpha_vantage", "B", "second first", T0, True),
        ("v", "newsdata", None, "", None, False),
    ]


def test_best_row_merge_of_a_frequent_key_joins_in_order(spark):
    n = 500
    rows = [("hot" if i % 3 else f"u{i}", "newsdata", f"t{i}", f"d{i}", T0, i) for i in range(n)]
    random.Random(1).shuffle(rows)
    got = {r.url: r for r in M.best_row_merge(news(spark, rows)).collect()}
    assert got["hot"].description == " ".join(f"d{i}" for i in range(n) if i % 3)
    assert got["hot"].title == "t1" and got["hot"].was_merged
    assert got["u3"].description == "d3" and not got["u3"].was_merged
    assert len(got) == 1 + len(range(0, n, 3))


def test_upsert_batch_wins_and_twice_equals_once(spark):
    schema = "url string, title string, search_terms array<string>, _seq bigint"
    main = spark.createDataFrame([("u", "old", ["a"], 1), ("v", "only main", ["b"], 2)], schema).drop("_seq")
    batch = spark.createDataFrame([("u", "new", ["c"], 1), ("w", "only batch", ["d"], 2)], schema)
    for unique in (False, True):
        once = M.upsert(batch, main, main_is_unique=unique)
        expected = [
            ("u", "new", ["a", "c"]), ("v", "only main", ["b"]), ("w", "only batch", ["d"]),
        ]
        assert rows_of(once, "url", "title", "search_terms") == expected
        twice = M.upsert(batch, once, main_is_unique=unique)
        assert rows_of(twice, "url", "title", "search_terms") == expected
    assert M.upsert(batch, None).count() == 2
    with pytest.raises(KeyError):
        M.upsert(batch, main.drop("title"))


def test_upsert_repairs_a_main_with_repeated_keys(spark):
    schema = "url string, title string, search_terms string, _seq bigint"
    main = spark.createDataFrame([("u", "b", "x", 2), ("u", "a", "y", 1), (None, "z", "z", 3)], schema)
    batch = spark.createDataFrame([("w", "c", "d", 1)], schema)
    assert rows_of(M.upsert(batch, main), "url", "title", "search_terms") == [
        ("u", "a", ["x", "y"]), ("w", "c", ["d"]),
    ]


def test_append_distinct(spark):
    new = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    main = spark.createDataFrame([("b", 2), ("c", 3)], "b string, a int")
    assert rows_of(M.append_distinct(new, main), "a", "b") == [(1, None), (2, "b"), (3, "c")]
    assert M.append_distinct(new, None).count() == 2


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line for line in plan.split("\n")), plan.count("FileScan")


def test_main_is_read_and_shuffled_once(spark, tmp_path):
    schema = "url string, title string, search_terms array<string>"
    spark.createDataFrame([("u", "old", ["a"])], schema).write.parquet(str(tmp_path / "main"))
    spark.createDataFrame([("u", "new", ["b"])], schema).write.parquet(str(tmp_path / "batch"))
    main, batch = (spark.read.parquet(str(tmp_path / n)) for n in ("main", "batch"))
    batch = batch.withColumn("_seq", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert exchanges(M.upsert(batch, main, main_is_unique=True)) == (2, 2)
        assert exchanges(M.append_distinct(main, main.limit(5).union(main)))[0] <= 2
        one = news(spark, [("u", "newsdata", "t", "d", T0, 1)])
        assert exchanges(M.best_row_merge(one))[0] == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ordinals_of_terms_pages_and_tables_never_tie(spark):
    from newsloom.plans.runs import ordered_union
    from newsloom.sources.landing import ingest_feed

    item = '{"title":"%s","url":"same","time_published":"20240101T000000","summary":"s"}'
    rows = [("ETH", 0, '{"feed":[%s]}' % (item % "eth")), ("BTC", 20240419153015, '{"feed":[%s]}' % (item % "late")), ("BTC", 3, '{"feed":[%s]}' % (item % "btc"))]
    envelopes = spark.createDataFrame(rows, "term string, page bigint, payload string")
    for order, want in ((["BTC", "ETH"], "btc"), (["ETH", "BTC"], "eth")):
        got = M.term_union(ingest_feed(envelopes, order), "url").collect()
        assert [(r.title, r.search_terms) for r in got] == [(want, ["BTC", "ETH"])]
    tables = [spark.createDataFrame([("b", 5)], "url string, _seq bigint"), spark.createDataFrame([("a",)], "url string")]
    assert [r.url for r in ordered_union(tables, ["url"]).orderBy("_seq").collect()] == ["b", "a"]


def test_last_seen_reads_lists_held_as_text(spark):
    df = spark.createDataFrame([("['BTC', 'ETH']", T0), ("[]", T0)], "ticker_names string, datetime timestamp_ntz")
    assert rows_of(M.last_seen(df), "ticker", "last_seen") == [("BTC", T0), ("ETH", T0)]


def test_source_rank(spark):
    df = spark.createDataFrame([("alpha_vantage",), ("newsdata",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(M.source_rank(F.col("s"))).collect()] == [1, 2, 999, 999]


def test_sorted_layer_splits_equal_times(spark):
    df = spark.range(1000).select(F.lit(T0).alias("datetime"), F.col("id").alias("_seq"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        parts = M.sorted_layer(df, "datetime", "_seq").groupBy(F.spark_partition_id()).count()
        assert parts.count() > 1
    finally:
        spark.conf.unset(coalesce)


def test_last_seen(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10), ["BTC", "ETH"]), (dt.datetime(2024, 1, 2, 12), ["BTC"]), (dt.datetime(2024, 1, 3, 14), ["ETH"])],
        "datetime timestamp_ntz, ticker_names array<string>",
    )
    assert M.last_seen(df, "btc").first()[0] == dt.datetime(2024, 1, 2, 12)
    assert M.last_seen(df, "DOGE").first()[0] is None
    assert {r.ticker: r.last_seen.day for r in M.last_seen(df).collect()} == {"BTC": 2, "ETH": 3}
