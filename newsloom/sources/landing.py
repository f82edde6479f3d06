"""API answers that were landed as JSON.

A landing folder has one subfolder ``term=<search term>`` per request and files named by page.
Fetching them is the job of whatever HTTP client lands them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.lookup import lookup
from newsloom.functions.parse import parse_ts
from newsloom.operators.merge import SEQ, keep_first
from newsloom.operators.validate import reject_reason
from newsloom.session import dimension, stored

# Fields of a news item per source, the list that holds them, and what names an item.
FEED_ITEM = (
    "title string, url string, time_published string, authors array<string>, summary string, "
    "source string, source_domain string, topics array<map<string,string>>, "
    "overall_sentiment_score double, overall_sentiment_label string, "
    "ticker_sentiment array<map<string,string>>"
)
PAGE_ITEM = (
    "title string, link string, creator array<string>, description string, pubDate string, "
    "source_name string, source_priority bigint, source_url string, country array<string>, "
    "category array<string>"
)

# Requested terms that may be broadcast.
MAX_BROADCAST_TERMS = 100_000


def _file_envelopes(text: DataFrame) -> DataFrame:
    """Whole files as envelopes; term and page come from where the file lies and what it is called."""

    def decoded(c: Column) -> Column:
        return F.url_decode(F.regexp_replace(c, r"\+", "%2B"))

    # The path is encoded once as a folder name and once more as a URL.
    term = decoded(decoded(F.regexp_extract("_metadata.file_path", "/term=([^/]*)/", 1)))
    page = F.regexp_extract("_metadata.file_name", r"(\d+)", 1).try_cast("long")
    return text.select(
        term.alias("term"), F.coalesce(page, F.lit(0)).alias("page"), F.col("value").alias("payload")
    )


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landed envelopes as rows (``term``, ``page``, ``payload``), one file each.

    The page is the first number in the file name.
    """
    return _file_envelopes(
        spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    )


def stream_landing(spark: SparkSession, path: str) -> DataFrame:
    """The same rows as a stream of the files that are new since the last run."""
    files = spark.readStream.option("recursiveFileLookup", "true").option("wholetext", "true")
    return _file_envelopes(files.text(path))


def read_landing_log(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes kept as JSON lines of ``term``, ``page`` and ``payload``: few large files that are
    split between tasks, for landings too large to be one file per envelope."""
    return spark.read.schema("term string, page bigint, payload string").json(path)


def _ordinal(requested: Sequence[str] | None) -> Column:
    """The place of an item: its term's place in the request, the term, the page, the place on the page.

    Items of terms that were not requested come last. It is a struct, so nothing in it has a limit.
    """
    terms = list(dict.fromkeys(requested or []))
    rank = F.coalesce(lookup({t: i for i, t in enumerate(terms)}, "int")(F.col("term")), F.lit(len(terms)))
    return F.struct(rank.alias("rank"), "term", F.col("page").cast("long").alias("page"), "pos")


def _items(envelopes: DataFrame, field: str, item: str, requested: Sequence[str] | None) -> DataFrame:
    """The items of all envelopes, with their places."""
    parsed = F.from_json("payload", f"struct<{field}:array<struct<{item}>>>")[field]
    return envelopes.select("term", "page", F.posexplode(parsed).alias("pos", "item")).select(
        "term", _ordinal(requested).alias(SEQ), "item.*"
    )


def _finish(items: DataFrame, once_per: str, published: str) -> DataFrame:
    """One row per term and item name, with its search term and its time."""
    return (
        keep_first(items, ["term", once_per])
        .withColumn("search_terms", F.array("term"))
        .withColumn("datetime", parse_ts(F.col(published), strict=True))
        .drop("term")
    )


def ingest_feed(envelopes: DataFrame, requested: Sequence[str] | None = None) -> DataFrame:
    """Source A: items of ``feed``, the first one per URL and symbol, in the order of ``requested``."""
    return _finish(_items(envelopes, "feed", FEED_ITEM, requested), "url", "time_published")


def ingest_pages(envelopes: DataFrame, requested: Sequence[str] | None = None) -> DataFrame:
    """Source B: items of all ``results`` pages, the first one per title and term, in the order of ``requested``."""
    return _finish(_items(envelopes, "results", PAGE_ITEM, requested), "title", "pubDate")


def judged(envelopes: DataFrame, key: str, check_status: bool) -> DataFrame:
    """Envelopes with the reason to reject them, null for good ones."""
    reason = reject_reason(F.col("payload"), key, check_status)
    return envelopes.withColumn("reject_reason", reason)


def _usable_terms(judged_envelopes: DataFrame) -> DataFrame:
    """Terms that answered without any rejected envelope."""
    fine = F.bool_and(F.col("reject_reason").isNull()).alias("usable")
    return judged_envelopes.groupBy("term").agg(fine).where("usable").select("term")


def missed_terms(judged_envelopes: DataFrame, requested: Sequence[str]) -> DataFrame:
    """Requested terms without any answer, or with an answer that had to be rejected."""
    asked = dimension(judged_envelopes.sparkSession, term=list(requested))
    return asked.join(_usable_terms(judged_envelopes), "term", "left_anti")


def usable_envelopes(
    judged_envelopes: DataFrame, requested: Sequence[str] | None = None
) -> DataFrame:
    """Envelopes of the (requested) terms that answered without any rejected envelope.

    Terms are counted first and broadcast while they are few, so that no payload is shuffled however many of them
    one term has.
    """
    terms = _usable_terms(judged_envelopes)
    if requested is not None:
        asked = dimension(judged_envelopes.sparkSession, term=list(requested))
        terms = asked.join(terms, "term", "left_semi")
    if requested is None or len(requested) > MAX_BROADCAST_TERMS:
        terms = stored(terms, "terms")
        few = terms.limit(MAX_BROADCAST_TERMS + 1).count() <= MAX_BROADCAST_TERMS
    else:
        few = True
    terms = F.broadcast(terms) if few else terms
    return judged_envelopes.drop("reject_reason").join(terms, "term", "left_semi")


def page_completeness(envelopes: DataFrame, page_size: int = 10) -> DataFrame:
    """Per term: pages to expect, pages landed, and whether the last one points to a next one."""
    head = F.from_json("payload", "struct<totalResults:bigint,nextPage:string>")
    return (
        envelopes.select("term", "page", head.alias("head"))
        .groupBy("term")
        .agg(
            F.ceil(F.max("head.totalResults") / page_size).alias("expected_pages"),
            F.count(F.lit(1)).alias("pages_read"),
            F.max_by("head.nextPage", "page").alias("resume_from"),
        )
        .withColumn("incomplete", F.col("resume_from").isNotNull())
    )


def lookback_start(days: int, today: Column | None = None) -> Column:
    """Midnight UTC ``days`` days ago, zone-free. ``today`` makes results repeatable."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()) if today is None else today
    return F.date_sub(now.cast("date"), days).cast("timestamp_ntz")


def since_days(df: DataFrame, days: int | None, today: Column | None = None) -> DataFrame:
    """Rows from midnight UTC ``days`` ago on; all rows if ``days`` is null."""
    return df if days is None else df.where(F.col("datetime") >= lookback_start(days, today))
