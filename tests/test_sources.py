import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from newsloom.dictionaries import SOURCE_A
from newsloom.functions.parse import with_lists
from newsloom.functions.text import Lexicon
from newsloom.sources import files, landing
from newsloom.streaming.incremental import ingest_new

LEXICON = Lexicon({"good": 1.9, "bad": -2.5})


def feed_item(n, **changes):
    item = {
        "title": f"t{n} good", "url": f"u{n}", "time_published": f"202401{n:02d}T101500",
        "authors": ["a"], "summary": "s", "source": "src", "source_domain": "d",
        "topics": [{"topic": "Tech"}], "overall_sentiment_score": 0.1,
        "overall_sentiment_label": "x",
        "ticker_sentiment": [{"ticker": "CRYPTO:BTC", "ticker_sentiment_score": "0.5"}],
    }
    return {**item, **changes}


def land(folder, term, page, answer):
    target = folder / f"term={term.replace(':', '%3A')}"
    target.mkdir(parents=True, exist_ok=True)
    text = answer if isinstance(answer, str) else json.dumps(answer)
    (target / f"page-{page:04d}.json").write_text(text, encoding="utf-8")


def test_feed_from_files(spark, tmp_path):
    land(tmp_path, "CRYPTO:BTC", 1, {"items": "3", "feed": [feed_item(1), feed_item(2), feed_item(1, title="again")]})
    land(tmp_path, "CRYPTO:ETH", 1, {"feed": [feed_item(1, title="eth")]})
    land(tmp_path, "CRYPTO:XRP", 1, "Error: 403")
    envelopes = landing.judged(landing.read_landing(spark, str(tmp_path)), "feed", False)
    missed = landing.missed_terms(envelopes, ["CRYPTO:BTC", "CRYPTO:XRP", "CRYPTO:ADA"])
    assert sorted(r.term for r in missed.collect()) == ["CRYPTO:ADA", "CRYPTO:XRP"]
    only = landing.usable_envelopes(envelopes, ["CRYPTO:ETH", "CRYPTO:XRP"])
    assert [r.term for r in only.collect()] == ["CRYPTO:ETH"]
    got = landing.ingest_feed(landing.usable_envelopes(envelopes)).collect()
    assert sorted((r.url, r.title, r.search_terms[0]) for r in got) == [
        ("u1", "eth", "CRYPTO:ETH"), ("u1", "t1 good", "CRYPTO:BTC"), ("u2", "t2 good", "CRYPTO:BTC"),
    ]
    assert {r.datetime for r in got if r.url == "u2"} == {dt.datetime(2024, 1, 2, 10, 15)}


def page(results, **changes):
    return {"status": "success", "totalResults": 12, "nextPage": None, "results": results, **changes}


def test_pages_in_order_with_completeness(spark, tmp_path):
    item = {"link": "l", "pubDate": "2024-01-02 03:04:05"}
    land(tmp_path, "bitcoin OR btc", 10, page([{**item, "title": "B", "description": "late"}]))
    land(tmp_path, "bitcoin OR btc", 2, page([{**item, "title": "B", "description": "early"}, {**item, "title": "C"}], nextPage="x"))
    land(tmp_path, "eth", 1, page([{**item, "title": "D"}], nextPage="more"))
    envelopes = landing.read_landing(spark, str(tmp_path))
    got = {r.title: r for r in landing.ingest_pages(envelopes).collect()}
    assert got["B"].description == "early" and got["B"].search_terms == ["bitcoin OR btc"]
    report = {r.term: tuple(r)[1:] for r in landing.page_completeness(envelopes).collect()}
    assert report == {"bitcoin OR btc": (2, 2, None, False), "eth": (2, 1, "more", True)}


def test_landing_log(spark, tmp_path):
    log = tmp_path / "log.jsonl"
    log.write_text(json.dumps({"term": "t", "page": 1, "payload": json.dumps({"feed": [feed_item(1)]})}))
    assert landing.ingest_feed(landing.read_landing_log(spark, str(log))).count() == 1


def test_since_days(spark):
    df = spark.sql("SELECT explode(sequence(timestamp_ntz'2024-01-01 06:00:00', timestamp_ntz'2024-01-10 06:00:00', interval 1 day)) AS datetime")
    today = F.lit("2024-01-10 23:00:00").cast("timestamp_ntz")
    assert landing.since_days(df, 2, today).count() == 3
    assert landing.since_days(df, None).count() == 10
    assert landing.since_days(df, 1).count() == 0


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10, 5), 'a "quoted",\nline ', ["x", "y'z"], None), (dt.datetime(2024, 1, 2), " b", [], "n")],
        "datetime timestamp_ntz, title string, tags array<string>, note string",
    )
    path = files.write_csv(df, str(tmp_path / "out"), compress=True, versioned=True)
    assert path.endswith("out_20240101T1005_20240102T0000")
    back = with_lists(files.read_csv(spark, path, df.columns, strict=True), "tags")
    assert sorted(back.collect()) == sorted(df.collect())
    with pytest.raises(KeyError):
        files.write_csv(df, str(tmp_path / "x"), expected_columns=["nope"])
    with pytest.raises(ValueError):
        files.write_csv(df.limit(0), str(tmp_path / "x"))


@pytest.mark.parametrize("form", ["yaml", "json"])
def test_schema_next_to_the_csv(spark, tmp_path, form):
    df = spark.createDataFrame([("a: b", 1), (None, 2)], "s string, n bigint")
    path = files.write_csv(df, str(tmp_path / "out"), schema_format=form)
    lines = [r.value for r in spark.read.text(f"{path}.schema.{form}").collect()]
    entries = [json.loads(line.removeprefix("- ")) for line in lines]
    assert [(e["name"], e["type"], e["nullable"]) for e in entries] == [("s", "string", True), ("n", "int64", False)]
    assert entries[0]["examples"] == ["a: b"] and len(entries[1]["examples"]) == 2
    with pytest.raises(ValueError):
        files.write_schema(df, str(tmp_path / "x"), "xml")
    more = spark.createDataFrame([(i % 5, None) for i in range(9)], "n int, s string")
    target = files.write_schema(more, str(tmp_path / "more"), form, sample_size=4, normalize_types=False)
    entries = [json.loads(r.value.removeprefix("- ")) for r in spark.read.text(target).collect()]
    assert [(e["type"], e["examples"]) for e in entries] == [("int", ["0", "1", "2", "3"]), ("string", [])]


def test_lookback_start(spark):
    now = F.lit("2024-03-01 00:30:00").cast("timestamp_ntz")
    text = F.date_format(landing.lookback_start(1, now), "yyyyMMdd'T'HHmm")
    assert spark.range(1).select(text).first()[0] == "20240229T0000"


def test_folder_scan_and_summary(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"two, and\nmore"\n')
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("y,z\nb,c\n")
    (tmp_path / "old_c.csv").write_text("x,y\n9,9\n")
    (tmp_path / "broken.csv.gz").write_bytes(b"no gzip at all")
    (tmp_path / "d.txt").write_text("x\n1\n")
    got = files.folder_scan(spark, str(tmp_path), ["x", "y"], exclude="old")
    assert sorted((r.x or "", r.y) for r in got.collect()) == [("", "b"), ("1", "two, and\nmore")]
    summary = {r.compression: tuple(r)[1:] for r in files.folder_summary(spark, str(tmp_path), "old").collect()}
    assert summary == {"uncompressed": (1, 0), ".gz": (1, 1)}
    (tmp_path / "empty").mkdir()
    none = files.folder_scan(spark, str(tmp_path / "empty"), ["x"])
    assert none.columns == ["x"] and none.isEmpty()


def test_snapshots_keep_what_they_replace(spark, tmp_path):
    path = str(tmp_path / "main")
    assert files.read_snapshot(spark, path) is None
    one = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1)], "datetime timestamp_ntz, v int")
    files.write_snapshot(one, path)
    files.write_snapshot(files.read_snapshot(spark, path).withColumn("v", F.col("v") + 1), path)
    assert [r.v for r in files.read_snapshot(spark, path).collect()] == [2]
    assert len(files.snapshots(spark, path)) == 2


def test_streaming_ingest_takes_only_what_is_new(spark, tmp_path):
    folder, root = tmp_path / "landing", str(tmp_path / "lake")
    land(folder, "CRYPTO:BTC", 1, {"feed": [feed_item(1), feed_item(2)]})
    ingest_new(spark, str(folder), SOURCE_A, root, LEXICON).awaitTermination()
    main = f"{root}/processed/{SOURCE_A}/main"
    assert files.read_snapshot(spark, main).count() == 2
    land(folder, "CRYPTO:ETH", 1, {"feed": [feed_item(2, title="newer bad"), feed_item(3)]})
    ingest_new(spark, str(folder), SOURCE_A, root, LEXICON).awaitTermination()
    got = {r.url: r for r in files.read_snapshot(spark, main).collect()}
    assert sorted(got) == ["u1", "u2", "u3"]
    assert got["u2"].search_terms == ["CRYPTO:BTC", "CRYPTO:ETH"]
    assert got["u2"].sentiment_label_nltk == "Negative"
    assert len(files.snapshots(spark, main)) == 2
