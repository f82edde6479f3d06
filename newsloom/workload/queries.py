"""Every operator as a query over the given tables. Lists are joined to text so that results compare."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.dictionaries import MERGED_COLUMNS, SOURCE_A, SOURCE_B
from newsloom.functions import parse as P
from newsloom.functions import text as X
from newsloom.operators import merge as M
from newsloom.operators import profile, resample, semantic, sentences, terms, validate
from newsloom.operators.dictionary import with_dictionary
from newsloom.plans import runs
from newsloom.session import scratch_path, stored
from newsloom.sources import files, landing, tables
from newsloom.workload import fixture as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def joined(c: Column | str) -> Column:
    return F.array_join(F.col(c) if isinstance(c, str) else c, "|", "~")


def with_text_lists(df: DataFrame) -> DataFrame:
    lists = [n for n, t in df.dtypes if t == "array<string>"]
    return df.withColumns({n: joined(n) for n in lists}) if lists else df


# Sources


@query
def ingest_feed(spark, sf_dir):
    items = landing.ingest_feed(fx.feed_envelopes(fx.articles(spark, sf_dir)))
    return items.select(
        "title", "url", "summary", "source", "source_domain", "overall_sentiment_score", "datetime",
        joined("authors").alias("authors"), joined("search_terms").alias("search_terms"),
        joined(P.pluck(F.col("topics"), "topic")).alias("topics"),
    )


@query
def ingest_pages(spark, sf_dir):
    items = landing.ingest_pages(fx.page_envelopes(fx.articles(spark, sf_dir)))
    return items.select(
        "title", "link", "description", "source_name", "source_priority", "source_url", "datetime",
        joined("creator").alias("creator"), joined("country").alias("country"),
        joined("search_terms").alias("search_terms"),
    )


@query
def page_completeness(spark, sf_dir):
    return landing.page_completeness(fx.page_envelopes(fx.articles(spark, sf_dir)))


@query
def ingest_multi_term(spark, sf_dir):
    envelopes = fx.partly_broken_envelopes(fx.articles(spark, sf_dir))
    judged = landing.judged(envelopes, "results", True)
    good = landing.usable_envelopes(judged, ["de", "en", "es", "fr"])
    return landing.ingest_pages(good).select(
        "title", "link", "datetime", joined("search_terms").alias("search_terms")
    )


@query
def ingest_then_union(spark, sf_dir):
    """Of a URL that came with several terms and places, the row of the first requested term wins."""
    news = fx.articles(spark, sf_dir).withColumn("url", F.concat(F.lit("https://x.example/"), (F.col("doc_id") % 97).cast("string")))
    items = landing.ingest_feed(fx.feed_envelopes(news), ["fr", "en", "es", "de"])
    return M.term_union(items, "url").select("url", "title", joined("search_terms").alias("search_terms"))


@query
def missed_terms(spark, sf_dir):
    envelopes = fx.partly_broken_envelopes(fx.articles(spark, sf_dir))
    judged = landing.judged(envelopes, "results", True)
    return landing.missed_terms(judged, ["de", "en", "es", "fr", "xx"])


@query
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    news = fx.articles(spark, sf_dir).select(
        "doc_id", "title", "description",
        F.expr("CASE WHEN doc_id % 4 = 0 THEN 'no date' ELSE CAST(datetime AS STRING) END").alias("datetime"),
    )
    files.write_csv(news, path)
    return files.read_csv(spark, path, news.columns).withColumn("doc_id", F.col("doc_id").cast("long"))


def _two_formats(spark, sf_dir) -> str:
    path = scratch_path(spark, "folder")
    news = fx.articles(spark, sf_dir)
    alpha = news.where("data_source = 'alpha'").select("doc_id", "title", "lang")
    beta = news.where("data_source = 'beta'").select("doc_id", "title", "source")
    # Dealt out in turn, which no setting and no earlier partitioning takes away.
    files.write_csv(alpha.repartition(4), f"{path}/alpha", compress=True)
    files.write_csv(beta.repartition(3), f"{path}/beta")
    return path


@query
def folder_scan(spark, sf_dir):
    scanned = files.folder_scan(spark, _two_formats(spark, sf_dir), ["doc_id", "title", "lang"])
    return scanned.select(F.col("doc_id").cast("long").alias("doc_id"), "title", "lang")


@query
def folder_summary(spark, sf_dir):
    return files.folder_summary(spark, _two_formats(spark, sf_dir))


@query
def lookback(spark, sf_dir):
    today = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    events = fx.table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("datetime"))
    return landing.since_days(events, 10, today)


# Sinks and tables


@query
def sink_roundtrip(spark, sf_dir):
    news = fx.articles(spark, sf_dir).select("doc_id", "title", "description", "datetime", "search_terms")
    news = P.with_lists(news, "search_terms")
    path = files.write_csv(
        news, scratch_path(spark, "sink"), compress=True, versioned=True, expected_columns=["datetime"]
    )
    back = P.with_lists(files.read_csv(spark, path, news.columns, strict=True), "search_terms")
    return with_text_lists(back.withColumn("doc_id", F.col("doc_id").cast("long")))


@query
def version_span(spark, sf_dir):
    return profile.version_span(fx.articles(spark, sf_dir))


@query
def schema_profile(spark, sf_dir):
    return profile.schema_profile(P.with_lists(fx.articles(spark, sf_dir), "search_terms"))


@query
def schema_profile_samples(spark, sf_dir):
    """Four examples of each column, under Spark's own type names."""
    news = fx.articles(spark, sf_dir).select("doc_id", "source", "lang", "data_source", "datetime", M.SEQ)
    return profile.schema_profile(news, sample_size=4, normalize_types=False)


@query
def guards(spark, sf_dir):
    """What the guards on columns and on empty results let through, and what they say otherwise."""
    docs = fx.table(spark, sf_dir, "documents")
    cases = {
        "whole": lambda: validate.require_rows(validate.require_columns(docs, ["doc_id", "text"]), "documents"),
        "german": lambda: validate.require_rows(docs.where("lang = 'de'"), "german"),
        "columns": lambda: validate.require_columns(docs, ["doc_id", "title", "url"]),
        "rows": lambda: validate.require_rows(docs.where("lang = 'xx'"), "documents in xx"),
    }

    def outcome(name: str) -> DataFrame:
        try:
            passed, said = cases[name](), None
        except (KeyError, ValueError) as error:
            passed, said = docs.limit(0), str(error.args[0])
        return passed.agg(F.count("*").alias("n")).select(F.lit(name).alias("guard"), "n", F.lit(said).cast("string").alias("said"))

    return functools.reduce(DataFrame.unionByName, map(outcome, cases))


@query
def upsert_main(spark, sf_dir):
    news = fx.articles(spark, sf_dir).select(
        "url", "title", "description", "datetime", "search_terms", "data_source", M.SEQ
    )
    main = M.term_union(news.where("data_source = 'alpha'"), "url")
    batch = news.where("data_source = 'beta'")
    return with_text_lists(M.upsert(batch, main, "url", main_is_unique=True))


@query
def upsert_main_any(spark, sf_dir):
    """The same over a main table that may repeat keys."""
    news = fx.articles(spark, sf_dir).select(
        "url", "title", "description", "datetime", "search_terms", "data_source", M.SEQ
    )
    alpha = news.where("data_source = 'alpha'")
    return with_text_lists(M.upsert(news.where("data_source = 'beta'"), alpha.unionByName(alpha), "url"))


@query
def upsert_buckets(spark, sf_dir):
    """The same in a bucketed main table: three batches, each of which reads and writes its own buckets only."""
    news = fx.articles(spark, sf_dir).select(
        "url", "title", "description", "datetime", "search_terms", "data_source", M.SEQ
    )
    path = scratch_path(spark, "main")
    beta = F.col("data_source") == "beta"
    for part in (~beta, beta & (F.crc32("url") % 16 > 0), beta & (F.crc32("url") % 16 == 0)):
        tables.upsert_main(news.where(part), path, bucket_rows=40)
    return with_text_lists(tables.read_snapshot(spark, path))


@query
def append_buckets(spark, sf_dir):
    """Appends to a bucketed main table, one of them twice."""
    news = fx.articles(spark, sf_dir).select("url", "source", "lang", "data_source")
    path = scratch_path(spark, "main")
    for part in ("data_source = 'alpha'", "data_source = 'beta'", "data_source = 'beta'"):
        tables.append_main(news.where(part).drop("data_source"), path, bucket_rows=100)
    return tables.read_snapshot(spark, path)


@query
def append_distinct(spark, sf_dir):
    news = fx.articles(spark, sf_dir).select("url", "source", "lang", "data_source")
    new = news.where("data_source = 'beta'").drop("data_source")
    return M.append_distinct(new, news.drop("data_source").distinct())


@query
def sorted_layer(spark, sf_dir):
    return M.sorted_layer(
        fx.articles(spark, sf_dir).select("datetime", "doc_id", "url"), "datetime", "doc_id"
    )


# Validation and profiling


@query
def envelope_validation(spark, sf_dir):
    envelopes = fx.broken_envelopes(fx.articles(spark, sf_dir))
    return landing.judged(envelopes, "results", True).select("term", "page", "reject_reason")


@query
def kind_profile(spark, sf_dir):
    return _rounded_shares(validate.kind_profile(fx.messy_lists(spark, sf_dir), "raw"))


@query
def element_kind_profile(spark, sf_dir):
    return _rounded_shares(validate.element_kind_profile(fx.messy_lists(spark, sf_dir), "raw"))


def _rounded_shares(df: DataFrame) -> DataFrame:
    return df.withColumn("share", F.round("share", 6))


# Parsing


@query
def project_rename(spark, sf_dir):
    return runs.select_common(fx.raw_b(fx.articles(spark, sf_dir)), SOURCE_B).drop(M.SEQ)


@query
def is_missing(spark, sf_dir):
    value = F.expr("CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') WHEN 2 THEN 0.0D ELSE value END")
    return fx.table(spark, sf_dir, "events").select(
        "event_id", P.is_missing(value, floating=True).alias("missing")
    )


def _lists(spark, sf_dir, parse) -> DataFrame:
    return fx.messy_lists(spark, sf_dir).select(
        "doc_id", joined(parse(F.col("raw"))).alias("items"), F.size(parse(F.col("raw"))).cast("long").alias("n")
    )


@query
def parse_list(spark, sf_dir):
    return _lists(spark, sf_dir, P.parse_list)


@query
def normalize_list(spark, sf_dir):
    return _lists(spark, sf_dir, P.normalize_list)


@query
def normalize_terms(spark, sf_dir):
    return _lists(spark, sf_dir, P.normalize_terms)


@query
def parse_numbers(spark, sf_dir):
    """Numbers in lists read like ``str`` writes them; search terms know literals only."""
    raw = F.col("raw")
    return fx.number_lists(spark, sf_dir).select(
        "doc_id", joined(P.parse_list(raw)).alias("items"), F.size(P.normalize_terms(raw)).cast("long").alias("n_terms")
    )


@query
def safe_eval(spark, sf_dir):
    whole = F.when(F.col("raw").startswith("[broken"), F.col("raw").substr(F.lit(2), F.lit(10))).otherwise(F.col("raw"))
    raw = fx.messy_lists(spark, sf_dir).select("doc_id", whole.alias("raw"))
    return raw.select("doc_id", joined(P.safe_eval(F.col("raw"))).alias("items"))


@query
def normalize_dicts(spark, sf_dir):
    items = P.normalize_dicts(F.col("raw"))
    return fx.messy_dicts(spark, sf_dir).select(
        "doc_id",
        F.size(items).cast("long").alias("n"),
        joined(P.pluck(items, "ticker")).alias("tickers"),
        joined(P.pluck(items, "lang")).alias("langs"),
    )


@query
def pluck_key(spark, sf_dir):
    items = P.normalize_dicts(F.col("ticker_sentiment"))
    return fx.articles(spark, sf_dir).select("doc_id", joined(P.pluck(items, "ticker")).alias("tickers"))


@query
def lower_items(spark, sf_dir):
    items = F.expr("array(upper(source), CASE WHEN lang = 'en' THEN NULL ELSE upper(lang) END, event_type)")
    events = fx.table(spark, sf_dir, "events").selectExpr("event_id AS doc_id", "upper(event_type) AS event_type")
    docs = fx.table(spark, sf_dir, "documents").join(events, "doc_id")
    return docs.select("doc_id", joined(P.lower_items(items)).alias("items"))


@query
def strip_ticker(spark, sf_dir):
    tickers = P.pluck(P.normalize_dicts(F.col("ticker_sentiment")), "ticker")
    return fx.articles(spark, sf_dir).select("doc_id", joined(P.strip_tickers(tickers)).alias("tickers"))


@query
def strip_scheme(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select("page_id", P.strip_scheme(F.col("url")).alias("bare_url"))


@query
def parse_ts(spark, sf_dir):
    text = F.expr(
        """CASE event_id % 4 WHEN 0 THEN date_format(ts, "yyyyMMdd'T'HHmmss")
             WHEN 1 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm")
             WHEN 2 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') ELSE event_type END"""
    )
    return fx.table(spark, sf_dir, "events").select("event_id", P.parse_ts(text).alias("at"))


@query
def keyword_tag(spark, sf_dir):
    tickers = X.keyword_tickers(F.col("title"), fx.KEYWORDS)
    return fx.articles(spark, sf_dir).select("doc_id", joined(tickers).alias("tickers"))


@query
def filter_ticker(spark, sf_dir):
    item = P.item_of(P.normalize_dicts(F.col("ticker_sentiment")), "crypto:click")
    return fx.articles(spark, sf_dir).select(
        "doc_id", F.try_element_at(item, F.lit("ticker_sentiment_score")).alias("score")
    )


@query
def ticker_frame(spark, sf_dir):
    item = P.item_of(P.normalize_dicts(F.col("ticker_sentiment")), "FOREX:U1")
    return fx.articles(spark, sf_dir).select("doc_id", item.alias("item")).select(
        "doc_id", *P.item_columns(F.col("item"))
    )


# Text and sentiment


@query
def preprocess_text(spark, sf_dir):
    clean = X.preprocess_text(F.col("text"), fx.LEXICON.stopwords, fx.LEXICON.base_forms)
    return fx.table(spark, sf_dir, "documents").select("doc_id", clean.alias("clean"))


def _entries(spark, columns: str, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), columns)


@query
def preprocess_text_table(spark, sf_dir):
    """The same with stopwords and base forms that are tables."""
    docs = texts = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    toks = X.tokens(F.coalesce("text", F.lit("")))
    stop = _entries(spark, "word string, stop int", [(w, 1) for w in fx.LEXICON.stopwords])
    base = _entries(spark, "word string, form string", fx.LEXICON.base_forms.items())
    docs, is_stop = with_dictionary(docs, "doc_id", toks, stop, name="_stop")
    docs, form = with_dictionary(docs, "doc_id", toks, base, name="_base", source=texts)
    return docs.select("doc_id", X.preprocess_text(F.col("text"), is_stop, form).alias("clean"))


@query
def lexicon_score_table(spark, sf_dir):
    """The same with a lexicon that is a table."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = [(w, t["v"], t["b"], t["n"], t["drop"]) for w, t in fx.LEXICON.terms().items()]
    terms = _entries(spark, "word string, v double, b double, n boolean, drop boolean", rows)
    docs, term = with_dictionary(docs, "doc_id", fx.LEXICON.spoken(F.coalesce("text", F.lit(""))), terms)
    return docs.select("doc_id", X.lexicon_score(F.col("text"), fx.LEXICON, term).alias("score"))


@query
def keyword_tag_table(spark, sf_dir):
    """The same with keywords that are a table."""
    news = fx.articles(spark, sf_dir).select("doc_id", "title")
    rows = [(w.lower(), t.upper()) for t, ws in fx.KEYWORDS.items() for w in ws]
    news, ticker = with_dictionary(news, "doc_id", X.words(F.col("title")), _entries(spark, "word string, ticker string", rows))
    return news.select("doc_id", joined(X.keyword_tickers(F.col("title"), ticker)).alias("tickers"))


@query
def lexicon_score(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", X.lexicon_score(F.col("text"), fx.LEXICON).alias("score")
    )


@query
def lexicon_score_rules(spark, sf_dir):
    """The same with the rules on several words: never so, least, but, idioms, boosters of two words."""
    return fx.table(spark, sf_dir, "documents").repartition("doc_id").select(
        "doc_id", X.lexicon_score(F.col("text"), fx.RULES_LEXICON).alias("score")
    )


@query
def sentiment_label(spark, sf_dir):
    score = (F.pmod("doc_id", F.lit(21)) - 10) / 100.0
    return fx.table(spark, sf_dir, "documents").select("doc_id", X.sentiment_label(score).alias("label"))


@query
def score_average(spark, sf_dir):
    score = X.article_score(F.col("title"), F.col("description"), fx.LEXICON)
    return fx.articles(spark, sf_dir).select("doc_id", F.round(score, 6).alias("score"))


@query
def rescore_masked(spark, sf_dir):
    old = fx.articles(spark, sf_dir).select(
        "doc_id", "title", "description",
        (F.col("data_source") == "beta").alias("was_merged"),
        F.lit(0.5).alias("sentiment_score_nltk"), F.lit("Old").alias("sentiment_label_nltk"),
    )
    return runs.rescore(old, "was_merged", fx.LEXICON).select(
        "doc_id", F.round("sentiment_score_nltk", 6).alias("score"),
        F.col("sentiment_label_nltk").alias("label"),
    )


@query
def prefix_terms(spark, sf_dir):
    return fx.articles(spark, sf_dir).select(
        "doc_id",
        joined(X.prefix_terms(F.col("title"), fx.SEARCH, fx.STEMS)).alias("terms"),
        joined(X.prefix_terms(F.col("title"), fx.SEARCH, fx.STEMS, False)).alias("found"),
    )


@query
def stem_terms(spark, sf_dir):
    return fx.articles(spark, sf_dir).select(
        "doc_id", joined(X.stem_terms(F.col("title"), fx.SEARCH, fx.STEMS)).alias("terms")
    )


def _search_tables(spark) -> tuple[DataFrame, DataFrame]:
    asked = [t for part in fx.SEARCH.split(" OR ") for more in part.split(" AND ") for t in more.split(",")]
    terms = _entries(spark, "term string, place int", [(t, i) for i, t in enumerate(asked)])
    return terms, _entries(spark, "word string, stem string", fx.STEMS.items())


@query
def prefix_terms_table(spark, sf_dir):
    """The same with terms and stems that are tables."""
    tables_ = _search_tables(spark)
    news = terms.prefix_terms_table(fx.articles(spark, sf_dir).select("doc_id", "title"), "doc_id", "title", *tables_)
    news = terms.prefix_terms_table(news, "doc_id", "title", *tables_, return_search_terms=False, name="found")
    return news.select("doc_id", joined("terms").alias("terms"), joined("found").alias("found"))


@query
def stem_terms_table(spark, sf_dir):
    """The same with terms and stems that are tables."""
    news = terms.stem_terms_table(fx.articles(spark, sf_dir).select("doc_id", "title"), "doc_id", "title", *_search_tables(spark))
    return news.select("doc_id", joined("terms").alias("terms"))


@query
def abbreviations(spark, sf_dir):
    """Words that the texts use as abbreviations, with their counts."""
    learned = sentences.learn_abbreviations(fx.table(spark, sf_dir, "documents"), "text")
    return learned.where("abbreviation").select("word", "n_stop", "n_plain", F.round("score", 6).alias("score"), "starter")


@query
def split_sentences_learned(spark, sf_dir):
    """Sentences of the splitter that learns its abbreviations from all texts."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = stored(sentences.learn_abbreviations(docs, "text"), "abbreviations")
    split = sentences.split_sentences_learned(docs, "doc_id", "text", learned)
    return split.select("doc_id", F.posexplode("sentences").alias("pos", "sentence")).withColumn("pos", F.col("pos").cast("long"))


@query
def split_sentences(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(X.split_sentences(F.col("text"))).alias("pos", "sentence")
    ).withColumn("pos", F.col("pos").cast("long"))


@query
def normalize_sentence(spark, sf_dir):
    text = F.col("text")
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id",
        X.normalize_sentence(text).alias("spaced"),
        X.normalize_sentence(text, "tokens").alias("tokens"),
        X.normalize_sentence(text, "hybrid").alias("hybrid"),
    )


@query
def semantic_dedup(spark, sf_dir):
    vectors = fx.table(spark, sf_dir, "embeddings")
    kept = semantic.greedy_dedup(vectors, "label", "vec_id", "embedding", threshold=0.3)
    return kept.select("label", "vec_id")


@query
def semantic_dedup_rounds(spark, sf_dir):
    """All vectors as one document, decided in parallel rounds over small blocks."""
    vectors = fx.table(spark, sf_dir, "embeddings").withColumn("doc", F.lit("all"))
    kept = semantic.greedy_dedup(vectors, "doc", "vec_id", "embedding", threshold=0.3, whole=100, block=100)
    return kept.select("vec_id")


def _semantic_clean(spark, sf_dir, **sizes):
    merged = M.best_row_merge(
        fx.articles(spark, sf_dir).select("url", "data_source", "description", "datetime", M.SEQ),
        ranks=fx.RANKS,
    )
    return semantic.semantic_clean(stored(merged.drop(M.SEQ), "merged"), encode=fx.hashed_terms, **sizes).select(
        "url", "description", "was_merged", "removed_sent_count"
    )


@query
def semantic_clean_vectors(spark, sf_dir):
    """The same with vectors out of a table: each sentence has one of the given embeddings, some have none."""
    merged = M.best_row_merge(
        fx.articles(spark, sf_dir).select("url", "data_source", "description", "datetime", M.SEQ), ranks=fx.RANKS
    )
    merged = stored(merged.drop(M.SEQ), "merged")
    given = fx.table(spark, sf_dir, "embeddings")
    which = F.pmod(F.length("sentence") * 7 + F.col("pos") * 3, F.lit(given.count() + 20)).cast("long")
    rows = semantic.sentence_rows(merged).select("url", "pos", which.alias("vec_id"))
    vectors = rows.join(given, "vec_id").select("url", "pos", F.col("embedding").alias("vector"))
    return semantic.semantic_clean_vectors(merged, vectors, threshold=0.3, whole=64, block=32).select(
        "url", "description", "was_merged", "removed_sent_count"
    )


@query
def semantic_clean(spark, sf_dir):
    return _semantic_clean(spark, sf_dir)


@query
def semantic_clean_large(spark, sf_dir):
    """The same by rounds, as for documents that no task can hold."""
    return _semantic_clean(spark, sf_dir, whole=64, block=64)


# Unions, joins and merges


@query
def union_sources(spark, sf_dir):
    news = fx.articles(spark, sf_dir)
    alpha = news.where("data_source = 'alpha'").select("doc_id", "url", "title", "lang")
    beta = news.where("data_source = 'beta'").select("title", "source", "url", "doc_id")
    return M.union_sources([alpha, beta], ["doc_id", "url", "title"])


@query
def source_rank(spark, sf_dir):
    source = F.when(F.col("lang") == "de", F.lit("gamma")).otherwise(F.col("data_source"))
    return fx.articles(spark, sf_dir).select(
        "doc_id", M.source_rank(source, fx.RANKS).cast("long").alias("rank")
    )


@query
def best_row_merge(spark, sf_dir):
    news = fx.articles(spark, sf_dir).select(
        "url", "data_source", "description", "datetime", "title", "source", M.SEQ,
        F.when(F.col("data_source") == "beta", F.col("lang")).alias("lang"),
    )
    return M.best_row_merge(news, ranks=fx.RANKS).drop(M.SEQ)


@query
def term_union(spark, sf_dir):
    news = fx.articles(spark, sf_dir).select(
        "url", "title", "description", "datetime", "search_terms", M.SEQ
    )
    return with_text_lists(M.term_union(news, "url"))


@query
def dedup_first(spark, sf_dir):
    key = F.when(F.col("lang") != "es", F.col("url")).alias("key")
    news = fx.articles(spark, sf_dir).select(key, "title", "description", "datetime", M.SEQ)
    return M.keep_first(news, ["key"])


@query
def last_seen_ticker(spark, sf_dir):
    news = fx.articles(spark, sf_dir).select("datetime", F.col("search_terms").alias("ticker_names"))
    news = P.with_lists(news, "ticker_names")
    upper = news.withColumn("ticker_names", F.transform("ticker_names", F.upper))
    one = M.last_seen(upper, "click").select(F.lit("only CLICK").alias("ticker"), "last_seen")
    return M.last_seen(upper).unionByName(one)


# Time series


def _scored_articles(spark, sf_dir) -> DataFrame:
    """A score per article that needs no text: about a tenth of them has none."""
    score = F.expr("CASE WHEN doc_id % 11 > 0 THEN CAST(doc_id % 200 - 100 AS DOUBLE) / 100 END")
    return fx.articles(spark, sf_dir).select(
        "datetime", F.col("search_terms").alias("ticker_names"), score.alias("sentiment_score_nltk")
    )


def _rounded(series: DataFrame) -> DataFrame:
    return series.withColumn("score", F.round("score", 12))


@query
def resample_daily(spark, sf_dir):
    return _rounded(resample.resample_scores(_scored_articles(spark, sf_dir), "nltk", "D"))


@query
def resample_hourly(spark, sf_dir):
    return _rounded(resample.resample_scores(_scored_articles(spark, sf_dir), "nltk", "h"))


@query
def resample_nested(spark, sf_dir):
    return _rounded(resample.resample_nested(fx.articles(spark, sf_dir), "D"))


def _event_means(spark, sf_dir) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select(
        F.col("ts").alias("datetime"),
        F.concat("event_type", (F.col("user_id") % 7).cast("string")).alias("ticker"),
        F.col("value").alias("score"),
    )
    return resample.mean_per_bucket(events, "h")


@query
def gap_fill(spark, sf_dir):
    return _rounded(resample.fill_calendar(_event_means(spark, sf_dir), "h"))


@query
def fill_scores(spark, sf_dir):
    return _rounded(resample.fill_scores(resample.fill_calendar(_event_means(spark, sf_dir), "h"), 0.0))


TICKERS = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "U0", "U1", "U2", "U3", "U4", "VIEW"]


@query
def pivot_scores(spark, sf_dir):
    wide = resample.pivot_scores(resample.resample_nested(fx.articles(spark, sf_dir), "D"), TICKERS)
    return wide.select("bucket", *[F.round(t, 12).alias(t) for t in TICKERS])


@query
def pivot_blocks(spark, sf_dir):
    """The wide form in blocks of three tickers, read back as one table."""
    series = resample.resample_nested(fx.articles(spark, sf_dir), "D")
    paths = resample.write_wide(series, scratch_path(spark, "blocks"), width=3)
    wide = resample.read_wide(spark, paths, TICKERS)
    return wide.select("bucket", *[F.round(t, 12).alias(t) for t in TICKERS])


# Whole runs


@query
def transform_a(spark, sf_dir):
    done = runs.transform_a(fx.raw_a(fx.articles(spark, sf_dir)), fx.LEXICON)
    done = done.drop(M.SEQ, "topics", "ticker_sentiment")
    return with_text_lists(done.withColumn("sentiment_score_nltk", F.round("sentiment_score_nltk", 6)))


@query
def transform_b(spark, sf_dir):
    done = runs.transform_b(fx.raw_b(fx.articles(spark, sf_dir)), fx.LEXICON, fx.KEYWORDS).drop(M.SEQ)
    return with_text_lists(done.withColumn("sentiment_score_nltk", F.round("sentiment_score_nltk", 6)))


@query
def source_run(spark, sf_dir):
    """Merge terms per URL, transform, put the batch over the main table, and resample it by day."""
    news = fx.articles(spark, sf_dir)

    def processed(origin: str) -> DataFrame:
        clean = M.term_union(fx.raw_a(news.where(F.col("data_source") == origin)), "url")
        return stored(runs.transform_a(clean, fx.LEXICON), origin)

    main = M.upsert(processed("beta"), processed("alpha"), "url", main_is_unique=True)
    return _rounded(resample.resample_scores(main, "nltk", "D"))


ASKED = ["fr", "en", "es", "de"]


@query
def source_run_a(spark, sf_dir):
    """Two whole runs of source A, from landed envelopes to the processed main table, read back."""
    news, root = fx.articles(spark, sf_dir), scratch_path(spark, "lake")
    for origin in ("alpha", "beta"):
        envelopes = fx.feed_envelopes(news.where(F.col("data_source") == origin))
        good = landing.usable_envelopes(landing.judged(envelopes, "feed", False), ASKED)
        runs.run_source(landing.ingest_feed(good, ASKED), SOURCE_A, root, fx.LEXICON)
    main = files.read_snapshot(spark, f"{root}/processed/{SOURCE_A}/main")
    return with_text_lists(
        main.select(
            "url", "title", "datetime", "search_terms", "ticker_names", "sentiment_label_nltk",
            F.round("sentiment_score_nltk", 6).alias("sentiment_score_nltk"),
        )
    )


@query
def source_run_b(spark, sf_dir):
    """A whole run of source B, from landed pages to the hourly series of the batch, read back."""
    pages = fx.page_envelopes(fx.articles(spark, sf_dir))
    good = landing.usable_envelopes(landing.judged(pages, "results", True), ASKED)
    out = runs.run_source(
        landing.ingest_pages(good, ASKED), SOURCE_B, scratch_path(spark, "lake"), fx.LEXICON, keywords=fx.KEYWORDS
    )
    return _rounded(spark.read.parquet(out["resampled_h"]))


def _union_of_sources(spark, sf_dir) -> DataFrame:
    news = fx.articles(spark, sf_dir)
    a = runs.transform_a(fx.raw_a(news.where("data_source = 'alpha'")), fx.LEXICON)
    b = runs.transform_b(fx.raw_b(news.where("data_source = 'beta'")), fx.LEXICON, fx.KEYWORDS)
    return runs.ordered_union([a, b])


@query
def merge_clean(spark, sf_dir):
    done = runs.merge_clean(_union_of_sources(spark, sf_dir), fx.LEXICON, encode=fx.hashed_terms)
    return with_text_lists(
        done.select(*MERGED_COLUMNS).withColumn("sentiment_score_nltk", F.round("sentiment_score_nltk", 6))
    )


@query
def merge_clean_pieces(spark, sf_dir):
    """The same where most URLs have more text than may meet in one cell."""
    done = runs.merge_clean(_union_of_sources(spark, sf_dir), fx.LEXICON, encode=fx.hashed_terms, large_text=2000)
    return with_text_lists(
        done.select(*MERGED_COLUMNS).withColumn("sentiment_score_nltk", F.round("sentiment_score_nltk", 6))
    )


@query
def merge_run(spark, sf_dir):
    """Append the merge of both sources to an older main table: that of source A alone."""
    union = stored(_union_of_sources(spark, sf_dir), "processed")
    new = runs.merge_clean(union, fx.LEXICON, encode=fx.hashed_terms)
    old = runs.merge_clean(union.where("data_source = 'alpha_vantage'"), fx.LEXICON, encode=fx.hashed_terms)
    both = M.append_distinct(new.select(MERGED_COLUMNS), old.select(MERGED_COLUMNS))
    return with_text_lists(both.withColumn("sentiment_score_nltk", F.round("sentiment_score_nltk", 6)))


@query
def merge_run_layers(spark, sf_dir):
    """The same as two runs that write their layers; the merged main table is read back."""
    news, root = fx.articles(spark, sf_dir), scratch_path(spark, "lake")
    a = stored(runs.transform_a(fx.raw_a(news.where("data_source = 'alpha'")), fx.LEXICON), "a")
    b = stored(runs.transform_b(fx.raw_b(news.where("data_source = 'beta'")), fx.LEXICON, fx.KEYWORDS), "b")
    runs.run_merge([a], root, fx.LEXICON, encode=fx.hashed_terms)
    runs.run_merge([a, b], root, fx.LEXICON, encode=fx.hashed_terms)
    main = files.read_snapshot(spark, f"{root}/merged/main")
    return with_text_lists(main.withColumn("sentiment_score_nltk", F.round("sentiment_score_nltk", 6)))
