"""News tables derived from the given tables, and the small dictionaries the queries use."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import Lexicon

RANKS = {"alpha": 1, "beta": 2}

KEYWORDS = {
    "aaa": ["the", "of", "rewh"],
    "bbb": ["and", "der", "le"],
    "ccc": ["with", "by", "de la"],
    "ddd": ["que", "orantion"],
}
LEXICON = Lexicon(
    valence={
        "with": 1.9, "from": -1.5, "be": 0.7, "for": 1.2, "by": -2.1, "les": 0.8, "und": 1.1,
        "que": -0.9, "this": 2.4, "die": -1.3,
    },
    boosters={"it": 0.293, "en": -0.293, "des": 0.293},
    negations=("as", "an", "un"),
    stopwords=("to", "a", "in", "la", "der", "the"),
    base_forms={"was": "be", "is": "be", "are": "be", "th": "the", "thatin": "that"},
)
# Frequent words of the texts stand for the words that the scorer's rules ask for.
RULES_LEXICON = Lexicon(
    valence={"with": 1.9, "from": -1.5, "that": 0.7, "by": -2.1, "les": 0.8, "und": 1.1, "que": -0.9, "die": -1.3, "ass": -2.5},
    boosters={"it": 0.293, "en": -0.293, "sort of": -0.293},
    negations=("as", "an", "un", "never"),
    stopwords=("ou", "la"),
    base_forms={
        "the": "never", "and": "so", "of": "least", "is": "at", "was": "but", "de": "but", "der": "bad", "to": "ass", "be": "sort",
        "on": "of", "le": "yeah", "ist": "this", "for": "yeah", "in": "right", "re": "cut", "he": "it",
    },
    rules=True,
    idioms={"bad ass": 1.5, "yeah right": -2.0, "cut that yeah": 2.0, "with never": -1.0},
)
STEMS = {
    "orantion": "orant", "hehely": "hehe", "ononst": "onon", "thatin": "that", "threinger": "thre",
}
SEARCH = "orantion OR hehe AND that,zzz"


DIMENSIONS = 256
_TERM = re.compile(r"\w+|[^\w\s]")


class _Slots(dict):
    """The dimension of each term, remembered for as many terms as fit a worker."""

    def __missing__(self, term: str) -> int:
        slot = hashlib.md5(term.encode()).digest()[1] % DIMENSIONS
        if len(self) < 1 << 17:
            self[term] = slot
        return slot


_slots = _Slots()


def hashed_terms(sentences: Sequence[str]) -> np.ndarray:
    """Term counts by hash: an encoder that SQL can repeat, in place of a model's."""
    out = np.zeros((len(sentences), DIMENSIONS), dtype=np.float32)
    for row, sentence in enumerate(sentences):
        for term in _TERM.findall(sentence.lower()):
            out[row, _slots[term]] += 1
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per document; about three articles share a URL. ``_seq`` is the document id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "user_id")
    title = "split_part(text, chr(10), 1)"
    tickers = (
        """'[{"ticker":"CRYPTO:' || upper(event_type) || '","ticker_sentiment_score":"' """
        """|| CAST(doc_id % 201 - 100 AS STRING) || '"},{"ticker":"FOREX:U' """
        """|| CAST(user_id % 5 AS STRING) || '","ticker_sentiment_score":"' """
        """|| CAST(doc_id % 37 AS STRING) || '"}]'"""
    )
    # A small file is one row group, so one task would read all texts, and whatever follows is work per row.
    return docs.repartition("doc_id").join(events, docs.doc_id == events.event_id).selectExpr(
        "doc_id",
        "doc_id AS _seq",
        "'https://news.example/item/' || CAST(CAST(floor(doc_id / 3) AS BIGINT) AS STRING) AS url",
        "CASE WHEN doc_id % 3 = 0 THEN 'alpha' ELSE 'beta' END AS data_source",
        f"{title} AS title",
        f"nullif(substr(text, length({title}) + 2), '') AS description",
        "source",
        "lang",
        "ts AS datetime",
        """'["' || event_type || '"]' AS search_terms""",
        f"{tickers} AS ticker_sentiment",
    )


def messy_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of lists in the shapes that exports produce, around the source and language columns."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        """CASE doc_id % 9
             WHEN 0 THEN '["' || source || '", "' || lang || '"]'
             WHEN 1 THEN '[\\'' || source || '\\', \\'' || lang || '\\']'
             WHEN 2 THEN source
             WHEN 3 THEN NULL
             WHEN 4 THEN '[' || CAST(doc_id AS STRING) || ', 2]'
             WHEN 5 THEN '[None, True, "' || source || '"]'
             WHEN 6 THEN '[broken ' || lang
             WHEN 7 THEN '{"source": "' || source || '"}'
             ELSE '  ' || CAST(doc_id AS STRING) || ' ' END AS raw""",
    )


def number_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of floats, whole numbers and names, as JSON (odd ids) and as Python writes them."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        """'[' || CAST(doc_id AS STRING) || '.125, 1e' || CAST(doc_id % 21 AS STRING) || ', -2.5e-'
           || CAST(doc_id % 9 AS STRING) || ', 7' || CAST(doc_id AS STRING) || '0000000000000000000, '
           || CASE WHEN doc_id % 2 = 1 THEN 'true, null]' ELSE 'True, None]' END AS raw""",
    )


def messy_dicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of object lists: JSON, literal, mixed, no list, null."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        """CASE doc_id % 5
             WHEN 0 THEN '[{"ticker": "' || source || '"}, {"lang": "' || lang || '"}]'
             WHEN 1 THEN '[{\\'ticker\\': \\'' || source || '\\', \\'lang\\': None}]'
             WHEN 2 THEN '[{"ticker": "' || source || '"}, 2]'
             WHEN 3 THEN source
             ELSE NULL END AS raw""",
    )


def raw_a(news: DataFrame) -> DataFrame:
    """Articles as rows of source A."""
    return news.selectExpr(
        "title", "url",
        "date_format(datetime, \"yyyyMMdd'T'HHmmss\") AS time_published",
        "'[\\'' || source || '\\', \"' || lang || '\"]' AS authors",
        "description AS summary",
        "source", "source || '.example' AS source_domain",
        """'[{"topic":"Topic ' || upper(lang) || '","relevance_score":"0.5"},{"other":"x"}]' AS topics""",
        "CAST(doc_id % 200 - 100 AS DOUBLE) / 100 AS overall_sentiment_score",
        "'Neutral' AS overall_sentiment_label",
        "ticker_sentiment", "search_terms", "datetime", "_seq",
    )


def raw_b(news: DataFrame) -> DataFrame:
    """Articles as rows of source B."""
    return news.selectExpr(
        "title", "url AS link", "source AS creator", "description",
        "date_format(datetime, 'yyyy-MM-dd HH:mm:ss') AS pubDate",
        "source AS source_name", "doc_id AS source_priority",
        "'https://www.' || source || '.example/x' AS source_url",
        "'[\"' || lang || '\"]' AS country", "'[\\'top\\', \\'' || lang || '\\']' AS category",
        "search_terms", "datetime", "_seq",
    )


def _enveloped(news: DataFrame, item: list[str], field: str, head: str) -> DataFrame:
    """Ten articles per envelope and term (the language), as the API would answer."""
    items = F.array_sort(F.collect_list(F.struct("doc_id", *[F.expr(e) for e in item])))
    return (
        news.withColumn("page", F.floor(F.col("doc_id") / 10))
        .groupBy(F.col("lang").alias("term"), "page")
        .agg(items.alias(field))
        .selectExpr("term", "page", f"to_json(struct({head}, {field})) AS payload")
    )


def feed_envelopes(news: DataFrame) -> DataFrame:
    item = [
        "title", "url", "date_format(datetime, \"yyyyMMdd'T'HHmmss\") AS time_published",
        "array(source, lang) AS authors", "description AS summary", "source",
        "source || '.example' AS source_domain",
        "array(named_struct('topic', lang)) AS topics",
        "CAST(doc_id % 200 - 100 AS DOUBLE) / 100 AS overall_sentiment_score",
        "'Neutral' AS overall_sentiment_label",
        "array(named_struct('ticker', 'CRYPTO:' || upper(lang))) AS ticker_sentiment",
    ]
    return _enveloped(news, item, "feed", "CAST(size(feed) AS STRING) AS items")


def page_envelopes(news: DataFrame) -> DataFrame:
    item = [
        "title", "url AS link", "array(source) AS creator", "description",
        "date_format(datetime, 'yyyy-MM-dd HH:mm:ss') AS pubDate", "source AS source_name",
        "doc_id AS source_priority", "'https://www.' || source || '.example/x' AS source_url",
        "array(lang) AS country", "array('top') AS category",
    ]
    head = (
        "'success' AS status, 20 + page AS totalResults, "
        "CASE WHEN term IN ('en', 'de') THEN 'p' || CAST(page + 1 AS STRING) END AS nextPage"
    )
    return _enveloped(news, item, "results", head)


def broken_envelopes(news: DataFrame) -> DataFrame:
    """Answers of every kind: an HTTP error, a number, bad status, no key, an empty key, good ones."""
    return page_envelopes(news).selectExpr(
        "term", "page",
        """CASE page % 6
             WHEN 0 THEN 'Error: 403 for ' || term
             WHEN 1 THEN CAST(page AS STRING)
             WHEN 2 THEN replace(payload, '"status":"success"', '"status":"fail"')
             WHEN 3 THEN replace(payload, '"results":', '"other":')
             WHEN 4 THEN '{"status":"success","results":[]}'
             ELSE payload END AS payload""",
    )


def partly_broken_envelopes(news: DataFrame) -> DataFrame:
    """Only the Spanish term has answers that must be rejected."""
    return page_envelopes(news).selectExpr(
        "term", "page",
        "CASE WHEN term = 'es' AND page % 2 = 0 THEN 'Error: 500' ELSE payload END AS payload",
    )
