"""The operators as queries over whole given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.codes import codes_sql, vector_codes
from newsloom.llm.jaccard import jaccard_classes
from newsloom.llm.language import host_of, identify, markup_language, page_text
from newsloom.llm.licenses import scan_licenses
from newsloom.llm.mixing import MIX_SQL, mix_sources
from newsloom.llm.packing import packed_sequences
from newsloom.llm.suffixes import remove_repeats
from newsloom.llm import quality, toxicity
from newsloom.llm.topk import TOP_K_SQL, top_k
from newsloom.llm.variants import VARIANTS_SQL, spelling_variants
from newsloom.llm.vectors import near_duplicates
from newsloom.llm.warc import WARC_SQL, archive_pages, read_bundles

# The vocabulary file that documents are packed by. A parameter of the operators, never part of this repository.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score_texts(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages have all the evidence: text, the language that their markup declares, and a host with its suffix."""
    html = F.col("html")
    found = identify(_table(spark, sf_dir, "pages"), page_text(html), markup_language(html), host_of(F.col("url")), id_column="page_id")
    return found.select(F.col("row.page_id").alias("page_id"), "language", "probability", "rejected")


def op4_language_id_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form of the pipeline: documents declare their language in ``lang``; their source stands for the host and has no suffix."""
    found = identify(_table(spark, sf_dir, "documents"), F.col("text"), F.col("lang"), F.col("source"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "language", "probability", "rejected")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_sequences(_table(spark, sf_dir, "documents"), TOKENIZER)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_bundles(archive_pages(_table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(_table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(_table(spark, sf_dir, "embeddings"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score_texts(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_language_id": op4_language_id,
    "op4_language_id_documents": op4_language_id_documents,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_warc": op6_warc,
    "op7_license_scan": op7_license_scan,
    "op8_top_k": op8_top_k,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_mix_sources": op10_mix_sources,
    "op11_vector_codes": op11_vector_codes,
    "op12_quality": op12_quality,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op6_warc": WARC_SQL,
    "op8_top_k": TOP_K_SQL,
    "op10_mix_sources": MIX_SQL,
    "op11_vector_codes": codes_sql(),
    "op13_spelling_variants": VARIANTS_SQL,
}
