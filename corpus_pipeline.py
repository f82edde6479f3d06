"""From raw documents to packed training sequences.

Each stage reads all that its predecessor kept and returns the columns of documents, but for the last, which returns the
packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.jaccard import by_marks, jaccard_classes
from newsloom.llm.language import identify
from newsloom.llm.mixing import mix_sources
from newsloom.llm.packing import packed_sequences
from newsloom.llm.suffixes import remove_repeats
from newsloom.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Near copies share four fifths of their five-word shingles. The four words and 0.85 of op9 bind that query only.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. A text without letters, or in no known language, goes."""
    found = identify(docs.select(*COLUMNS), F.col("text"), F.col("lang"), F.col("source"))
    return found.where(~F.col("rejected")).select("row.*")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of smallest id. Of rows that share its id, one of smallest text.

    A document with no words or no id is in no group and stays.
    """
    classes = jaccard_classes(docs, k=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    docs = docs.select(*COLUMNS)
    firsts = classes.where("doc_id is null or component_id = doc_id").groupBy("doc_id").agg(F.max("n_shingles").alias("n"))
    repeated = classes.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    # Most documents are alone and stay where they are: only those that may go, or share an id, are dealt out by id.
    some, alone = by_marks(docs, classes.where("component_id != doc_id").select("doc_id").union(repeated.select("doc_id")))
    kept = some.join(firsts, "doc_id", "left_semi").select(*COLUMNS)
    if not repeated.isEmpty():
        few = some.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("r"))
        few = few.join(firsts, "doc_id", "left_semi").select("doc_id", "r.*").select(*COLUMNS)
        kept = kept.join(repeated, "doc_id", "left_anti").select(*COLUMNS).union(few)
    return alone.union(kept).union(docs.where("doc_id is null"))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of passages that occur earlier. A character that loses a byte goes whole."""
    kept = remove_repeats(docs, carry=COLUMNS[1:])
    text = F.try_validate_utf8(F.col("kept").cast("string"))
    text = F.coalesce(text, F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\N{REPLACEMENT CHARACTER}", ""))
    text = F.when(F.col("n_removed") > 0, text).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col("n_chars"))
    return kept.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. One that the mix does not take goes."""
    taken = mix_sources(docs, carry=COLUMNS[1:])
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return taken.where("copies > 0").withColumn("copy", copies).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packed_sequences(docs, TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mix_to_weights", mix_to_weights),
    ("best_fit_packing", best_fit_packing),
]

# Tokens, and the order of random numbers within Spark, are not SQL's: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what each returns is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
