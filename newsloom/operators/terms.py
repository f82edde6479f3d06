"""Search terms that are a table: found in titles by joins, so there may be any number of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.parse import empty_list
from newsloom.functions.text import TERM_WORD, words
from newsloom.operators.dictionary import with_dictionary

# Terms that a title without a match may get all of, in one cell.
MAX_ALL = 10_000


def _stemmed(rows: DataFrame, word: str, stems: DataFrame | None) -> DataFrame:
    """``rows`` with a column ``stem``: that of ``word`` in the table ``stems`` (word, stem), or the word itself."""
    if stems is None:
        return rows.withColumn("stem", F.col(word))
    known = stems.groupBy(F.col("word").alias("_w")).agg(F.min("stem").alias("_s"))
    return rows.join(known, F.col(word) == F.col("_w"), "left").withColumn("stem", F.coalesce("_s", word)).drop("_w", "_s")


def _asked(terms: DataFrame) -> DataFrame:
    """The distinct terms, trimmed and in small letters, with their place in the request (the first of equal ones)."""
    place = F.col("place") if "place" in terms.columns else F.lit(0)
    return terms.select(F.lower(F.trim("term")).alias("term"), place.alias("place")).where("term is not null").groupBy("term").agg(F.min("place").alias("place"))


def _vocabulary(df: DataFrame, found: Column) -> DataFrame:
    return df.select(F.explode(F.array_distinct(found)).alias("word")).distinct()


def prefix_terms_table(
    df: DataFrame, key: str, title: str, terms: DataFrame, stems: DataFrame | None = None, return_search_terms: bool = True, name: str = "terms"
) -> DataFrame:
    """``df`` with the terms whose stem starts a stemmed title word; all of them, in order, if none matches.

    With ``return_search_terms=False`` the matching title words, or nothing. ``terms`` has a column ``term`` and may have
    ``place``; ``stems`` has ``word`` and ``stem``. Stems of the titles' distinct words are taken apart into their
    beginnings, no longer than the longest term, and joined with the terms by equality. Of more than ``MAX_ALL`` terms,
    a title without a match gets null for all of them. A null title reads as the word ``None``.
    """
    asked = _stemmed(_asked(terms), "term", stems)
    found = words(F.coalesce(F.col(title), F.lit("None")))
    vocabulary = _stemmed(_vocabulary(df, found), "word", stems)
    longest = F.coalesce(asked.agg(F.max(F.length("stem"))).scalar(), F.lit(0))
    sizes = F.sequence(F.lit(0), F.least(F.length("stem"), longest))
    starts = vocabulary.select("stem").distinct().select("stem", F.explode(sizes).alias("n")).select("stem", F.substring(F.col("stem"), F.lit(1), F.col("n")).alias("start"))
    of_stem = starts.join(asked.select(F.col("stem").alias("start"), "term"), "start").groupBy("stem").agg(F.array_sort(F.collect_set("term")).alias("found"))
    entries = vocabulary.join(of_stem, "stem").select("word", "found")
    df, terms_of = with_dictionary(df, key, found, entries, name="_terms")
    if not return_search_terms:
        matched = F.array_sort(F.array_distinct(F.filter(found, lambda w: terms_of(w).isNotNull())))
        return df.withColumn(name, matched).drop("_terms")
    matched = F.array_sort(F.array_distinct(F.flatten(F.filter(F.transform(found, terms_of), lambda t: t.isNotNull()))))
    otherwise = F.lit(None).cast("array<string>")
    if asked.limit(MAX_ALL + 1).count() <= MAX_ALL:
        every = _asked(terms).agg(F.array_sort(F.collect_list(F.struct("place", "term")))["term"]).scalar()
        otherwise = F.coalesce(every, empty_list())
    return df.withColumn(name, matched).withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(otherwise)).drop("_terms")


def stem_terms_table(df: DataFrame, key: str, title: str, terms: DataFrame, stems: DataFrame | None = None, name: str = "terms") -> DataFrame:
    """``df`` with the terms found in a title as words (``$btc`` counts as ``btc``) or by equal stems, sorted.

    A word that is a term counts as that one; by its stem it counts as the last term of that stem (by place, then by
    letters). A null title has none.
    """
    asked = _stemmed(_asked(terms), "term", stems)
    found = F.transform(F.regexp_extract_all(F.lower(F.col(title)), F.lit(TERM_WORD), F.lit(0)), lambda w: F.regexp_replace(w, r"^[$#]+", ""))
    vocabulary = _stemmed(_vocabulary(df, found), "word", stems)
    by_stem = asked.groupBy("stem").agg(F.max(F.struct("place", "term"))["term"].alias("by_stem"))
    exact = asked.select(F.col("term").alias("word"), F.col("term").alias("exact"))
    entries = vocabulary.join(exact, "word", "left").join(by_stem, "stem", "left")
    entries = entries.select("word", F.coalesce("exact", "by_stem").alias("term")).where("term is not null")
    df, term = with_dictionary(df, key, found, entries, name="_terms")
    matched = F.array_sort(F.array_distinct(F.filter(F.transform(found, term), lambda t: t.isNotNull())))
    return df.withColumn(name, F.coalesce(matched, empty_list())).drop("_terms")
