"""Whole runs: transform a source, run a source, merge sources.

The functions up to ``merge_clean`` only build plans. ``run_source`` and ``run_merge`` write the
layers. A layer is computed once, into a scratch table, before it is sorted, and every step reads back the layer
before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.dictionaries import (
    COMMON_COLUMNS, COMMON_NAMES, MERGED_COLUMNS, SOURCE_A, SOURCE_B, SOURCE_COLUMNS, SOURCE_RANK,
    TICKER_KEYWORDS,
)
from newsloom.functions.parse import (
    lower_items, pluck, strip_scheme, strip_tickers, with_dicts, with_lists,
)
from newsloom.functions.text import Lexicon, article_score, keyword_tickers, sentiment_label
from newsloom.operators.merge import (
    SEQ, best_row_merge, term_union, union_sources,
)
from newsloom.operators.resample import resample_scores
from newsloom.operators.semantic import Encoder, clean_pieces, semantic_clean
from newsloom.operators.validate import require_columns
from newsloom.session import stored
from newsloom.sources.files import write_layer
from newsloom.sources.tables import append_main, upsert_main


# Characters of a URL's descriptions, all together, that may meet in one cell before similar sentences are dropped.
LARGE_TEXT = 16_000_000


def select_common(df: DataFrame, source: str) -> DataFrame:
    """The columns kept of a source, under their common names."""
    wanted = SOURCE_COLUMNS[source]
    extra = [SEQ] if SEQ in df.columns else []
    return require_columns(df, wanted).select(*wanted, *extra).withColumnsRenamed(COMMON_NAMES[source])


def scored(df: DataFrame, lexicon: Lexicon | None) -> DataFrame:
    """Add sentiment score and label, unless there is no lexicon."""
    if lexicon is None:
        return df
    score = article_score(F.col("title"), F.col("description"), lexicon)
    return df.withColumn("sentiment_score_nltk", score).withColumn(
        "sentiment_label_nltk", sentiment_label(F.col("sentiment_score_nltk"))
    )


def transform_a(df: DataFrame, lexicon: Lexicon | None) -> DataFrame:
    """Source A: typed lists, tickers and categories out of the nested items, sentiment."""
    typed = with_dicts(
        with_lists(select_common(df, SOURCE_A), "authors", "search_terms"),
        "topics", "ticker_sentiment",
    )
    return scored(
        typed.withColumns(
            {
                "data_source": F.lit(SOURCE_A),
                "category": lower_items(pluck(F.col("topics"), "topic")),
                "ticker_names": strip_tickers(pluck(F.col("ticker_sentiment"), "ticker")),
            }
        ),
        lexicon,
    )


def transform_b(
    df: DataFrame,
    lexicon: Lexicon | None,
    keywords: Mapping[str, Sequence[str]] = TICKER_KEYWORDS,
) -> DataFrame:
    """Source B: typed lists, tickers out of title words, sentiment."""
    typed = with_lists(
        select_common(df, SOURCE_B), "authors", "search_terms", "country", "category"
    )
    return scored(
        typed.withColumns(
            {
                "ticker_names": keyword_tickers(F.col("title"), keywords),
                "data_source": F.lit(SOURCE_B),
                "source_url": strip_scheme(F.col("source_url")),
            }
        ),
        lexicon,
    )


def rescore(df: DataFrame, flag: str, lexicon: Lexicon) -> DataFrame:
    """Score again where ``flag`` is set. Other rows keep theirs without being scored."""
    fresh = article_score(F.col("title"), F.col("description"), lexicon)
    columns = df.columns
    return (
        df.withColumn(
            "sentiment_score_nltk", F.when(F.col(flag), fresh).otherwise(F.col("sentiment_score_nltk"))
        )
        .withColumn(
            "sentiment_label_nltk",
            F.when(F.col(flag), sentiment_label(F.col("sentiment_score_nltk"))).otherwise(
                F.col("sentiment_label_nltk")
            ),
        )
        .select(columns)
    )


def merge_clean(
    union: DataFrame,
    lexicon: Lexicon,
    threshold: float = 0.9,
    *,
    encode: Encoder,
    ranks: Mapping[str, int] = SOURCE_RANK,
    large_text: int = LARGE_TEXT,
) -> DataFrame:
    """One row per URL with a joined description free of similar sentences, scored again.

    The merged rows are stored once, because finding and dropping similar sentences both read them. Descriptions of a URL
    that have more than ``large_text`` characters in all are not joined before similar sentences are gone: they stay
    rows, in as many tasks as they need, and only what is left meets in one cell. The table should be stored, or cheap
    to read, as lengths are counted first.
    """
    size = union.where(F.col("url").isNotNull()).groupBy("url").agg(F.sum(F.length("description")).alias("n"), F.count("description").alias("texts"))
    large = stored(size.where((F.col("n") > large_text) & (F.col("texts") > 1)).select("url"), "large")
    if large.isEmpty():
        merged = stored(best_row_merge(union, ranks=ranks), "merged")
        cleaned = semantic_clean(merged, threshold=threshold, encode=encode)
        return rescore(cleaned, "was_merged", lexicon).drop("was_merged", "removed_sent_count")
    union = stored(union, "union")
    merged = stored(best_row_merge(union.join(large, "url", "left_anti").select(union.columns), ranks=ranks), "merged")
    cleaned = semantic_clean(merged, threshold=threshold, encode=encode).drop("removed_sent_count")
    rows = union.join(large, "url", "left_semi").select(union.columns)
    # Without their texts, rows of any number are reduced before they are shuffled.
    bare = best_row_merge(rows.withColumn("description", F.lit(None).cast("string")), ranks=ranks).drop("description")
    texts = clean_pieces(rows, "url", SEQ, "description", threshold, encode=encode)
    bare = bare.withColumn("was_merged", F.lit(True)).join(texts.select("url", F.col("_text").alias("description")), "url", "left")
    bare = bare.withColumn("description", F.coalesce("description", F.lit("")))
    return rescore(cleaned.unionByName(bare.select(cleaned.columns)), "was_merged", lexicon).drop("was_merged")


def ordered_union(tables: Sequence[DataFrame], columns: Sequence[str] = COMMON_COLUMNS) -> DataFrame:
    """Union of the sources' common columns with one ordinal over all of them, table by table.

    It is the table's place, then the ordinal within the table. Tables without one, as main tables are, have no order
    of their own.
    """
    kind = next((t.schema[SEQ].dataType for t in tables if SEQ in t.columns), "long")

    def own(table: DataFrame):
        return F.col(SEQ).cast(kind) if SEQ in table.columns else F.lit(None).cast(kind)

    numbered = [
        t.withColumn(SEQ, F.struct(F.lit(i).alias("table"), own(t).alias("seq"))) for i, t in enumerate(tables)
    ]
    return union_sources(numbered, [*columns, SEQ])


def run_source(
    raw: DataFrame,
    source: str,
    root: str,
    lexicon: Lexicon,
    resample: bool = True,
    keywords: Mapping[str, Sequence[str]] = TICKER_KEYWORDS,
) -> dict[str, str]:
    """From raw rows to the clean, processed and resampled layers of a source, by name; main tables are read by ``read_snapshot``."""
    spark, name_of = raw.sparkSession, "link" if source == SOURCE_B else "url"

    def update_main(batch: DataFrame, layer: str, key: str) -> str:
        path = f"{root}/{layer}/{source}/main"
        upsert_main(batch, path, key)
        return path

    stamp = f"batch-{uuid.uuid4().hex}"
    out = {"clean": write_layer(term_union(raw, name_of), f"{root}/clean/{source}/{stamp}", ("datetime", name_of))}
    clean = spark.read.parquet(out["clean"])
    out["clean_main"] = update_main(clean, "clean", name_of)
    processed = (
        transform_a(clean, lexicon) if source == SOURCE_A else transform_b(clean, lexicon, keywords)
    )
    out["processed"] = write_layer(processed, f"{root}/processed/{source}/{stamp}", ("datetime", "url"))
    processed = spark.read.parquet(out["processed"])
    out["processed_main"] = update_main(processed, "processed", "url")
    for freq in ("D", "h") if resample else ():
        series = resample_scores(processed, "nltk", freq)
        path = f"{root}/resampled/{source}/{stamp}-{freq.upper()}"
        out[f"resampled_{freq}"] = write_layer(series, path, ("bucket", "ticker"))
    return out


def run_merge(tables: Sequence[DataFrame], root: str, lexicon: Lexicon, **options) -> dict[str, str]:
    """Merge the processed tables of all sources and append the result to the merged main table."""
    spark = tables[0].sparkSession
    cleaned = merge_clean(ordered_union(tables), lexicon, **options).select(MERGED_COLUMNS)
    stamp = f"batch-{uuid.uuid4().hex}"
    out = {"merged": write_layer(cleaned, f"{root}/merged/{stamp}", ("datetime", "url"))}
    out["merged_main"] = f"{root}/merged/main"
    append_main(spark.read.parquet(out["merged"]), out["merged_main"], ("datetime", "url"))
    return out
