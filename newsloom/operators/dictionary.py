"""Dictionaries that are tables: looked up by a join, so they may be of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_dictionary(
    df: DataFrame, key: str, words: Column, dictionary: DataFrame, word: str = "word", name: str = "_dictionary", source: DataFrame | None = None
) -> tuple[DataFrame, Callable[[Column], Column]]:
    """``df`` with a column ``name``, and a function that looks a word up in it, null if it is not there.

    The column holds the entries that each row's ``words`` need. They are found by a join of each row's distinct words
    with the dictionary, which Spark broadcasts while it is small; texts take no part in it, and only words that the
    dictionary has are grouped by ``key``. Rows of one key
    share their entries, so keys may repeat or be null. If ``df`` is itself a join, give as ``source`` the table of its
    rows without it: words are then found there, and the join is not made for them. A dictionary of one further column gives its values, one of
    several gives structs. Of entries with the same word the smallest counts; null words are never found.
    """
    values = [c for c in dictionary.columns if c != word]
    value = F.col(values[0]) if len(values) == 1 else F.struct(*values)
    entries = dictionary.where(F.col(word).isNotNull()).groupBy(F.col(word).alias("_word")).agg(F.min(value).alias("_value"))
    source = df if source is None else source
    needed = source.select(F.col(key).alias("_key"), F.explode(F.array_distinct(words)).alias("_word"))
    found = needed.join(entries, "_word").groupBy("_key").agg(
        F.map_from_entries(F.collect_set(F.struct("_word", "_value"))).alias(name)
    )
    joined = df.join(found, df[key].eqNullSafe(found["_key"]), "left").drop("_key")
    return joined, lambda w: F.try_element_at(F.col(name), w)
