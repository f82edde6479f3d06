"""Sentence splitting that learns abbreviations from the texts themselves (Kiss and Strunk 2006).

A full stop before white space ends a sentence unless its word is an abbreviation. Words are judged by counts over all
texts: an abbreviation nearly always has its full stop (a likelihood ratio against chance), is short, may have stops
within, and is rare without one. After an abbreviation a sentence begins only with a word that is written small within
sentences and never large there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.lookup import let
from newsloom.functions.parse import WS, strip
from newsloom.operators.dictionary import with_dictionary
from newsloom.session import stored

# The published share of stops of a true abbreviation and the least score of one.
ALWAYS, LEAST_SCORE = 0.99, 0.3

_HEAD, _TAIL = r"^[^\p{L}\p{N}]+", r"[^\p{L}\p{N}.]+$"
_TYPE = r"^\p{L}+(?:\.\p{L}+)*\.?$"
_ENDED = r"[.!?][^\p{L}\p{N}.!?]*$"
_PART = rf"(?s)(.*?(?:[.!?]{WS}+|\z))"
# A code point that no text may hold parts sentences while they are put together.
_BREAK = "￿"


def _clean(token: Column) -> Column:
    """A token without quotes, brackets and commas around it; a full stop at its end stays."""
    return F.regexp_replace(F.regexp_replace(token, _HEAD, ""), _TAIL, "")


def _type(clean: Column) -> Column:
    """The word of a cleaned token: small letters, without the final full stop."""
    return F.regexp_replace(F.lower(clean), r"\.$", "")


def _is_large(clean: Column) -> Column:
    first = F.substring(clean, 1, 1)
    return first != F.lower(first)


def learn_abbreviations(df: DataFrame, text: str) -> DataFrame:
    """Rows (word, n_stop, n_plain, score, abbreviation, starter), one for each word of all texts.

    Tokens are counted as they stand, and only different ones are taken apart. The words are stored once, because their
    total is needed for each. A null text has no tokens. Without any full stop there are no abbreviations.
    """
    split = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), f"{WS}+"), lambda t: t != "")
    pairs = let(split, lambda ts: F.transform(ts, lambda t, i: F.struct(t.alias("token"), F.get(ts, i - 1).alias("before"))))
    within = F.col("p.before").isNotNull() & ~F.col("p.before").rlike(_ENDED)
    raw = df.select(F.explode(pairs).alias("p")).groupBy(F.col("p.token").alias("token"), within.alias("within")).agg(F.count(F.lit(1)).alias("n"))
    tokens = raw.select(_clean(F.col("token")).alias("clean"), "within", "n").where(F.col("clean").rlike(_TYPE))
    stop, large = F.col("clean").endswith("."), _is_large(F.col("clean"))

    def times(which: Column) -> Column:
        return F.sum(F.when(which, F.col("n")).otherwise(0))

    counted = tokens.groupBy(_type(F.col("clean")).alias("word")).agg(
        times(stop).alias("n_stop"), times(~stop).alias("n_plain"), times(~large).alias("n_small"), times(large & F.col("within")).alias("n_large_within")
    )
    counted = stored(counted, "words")
    total = counted.agg(F.struct(F.sum("n_stop").alias("stops"), F.sum(F.col("n_stop") + F.col("n_plain")).alias("all"))).scalar()
    share = F.least(F.greatest(total["stops"] / total["all"], F.lit(1e-12)), F.lit(1 - 1e-12))
    chance = F.col("n_stop") * F.log(share) + F.col("n_plain") * F.log(1 - share)
    sure = F.col("n_stop") * F.log(F.lit(ALWAYS)) + F.col("n_plain") * F.log(F.lit(1 - ALWAYS))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    stops_within = F.length("word") - letters
    score = -2 * (chance - sure) * F.exp(-letters.cast("double")) * (stops_within + 1) * F.pow(letters.cast("double"), -F.col("n_plain").cast("double"))
    return counted.select(
        "word", "n_stop", "n_plain", score.alias("score"),
        ((F.col("n_stop") > 0) & (score >= LEAST_SCORE)).alias("abbreviation"),
        ((F.col("n_small") > 0) & (F.col("n_large_within") == 0)).alias("starter"),
    )


def split_sentences_learned(df: DataFrame, key: str, text: str, learned: DataFrame, name: str = "sentences") -> DataFrame:
    """``df`` with a column of sentences: those of ``split_sentences``, but for breaks after abbreviations.

    ``learned`` is what ``learn_abbreviations`` gives, for these texts or others; it is joined with the words beside
    possible breaks only, so it may be of any size. Rows of one ``key`` may repeat. White space within a sentence stays
    as it is. A null or blank text has no sentences.
    """
    parts = F.filter(F.regexp_extract_all(strip(F.coalesce(F.col(text), F.lit(""))), F.lit(_PART), F.lit(1)), lambda p: p != "")

    def beside(p: Column) -> Column:
        ends = lambda words: F.struct(p.alias("part"), _clean(F.element_at(words, -1)).alias("last"), _clean(F.element_at(words, 1)).alias("first"))
        return let(F.split(strip(p), f"{WS}+"), ends)

    df = df.withColumn("_parts", F.transform(parts, beside))
    some = learned.where("abbreviation or starter").select("word", "abbreviation", "starter")
    ends = F.transform(F.filter("_parts", lambda x: x["last"].endswith(".")), lambda x: _type(x["last"]))
    needed = F.concat(ends, F.transform("_parts", lambda x: _type(x["first"])))
    df, known = with_dictionary(df, key, needed, some, name="_known")

    def breaks(before: Column, x: Column) -> Column:
        abbreviation = before["last"].endswith(".") & F.coalesce(known(_type(before["last"]))["abbreviation"], F.lit(False))
        begins = _is_large(x["first"]) & F.coalesce(known(_type(x["first"]))["starter"], F.lit(False))
        return ~abbreviation | begins

    marked = F.transform("_parts", lambda x, i: F.concat(F.when((i > 0) & breaks(F.get("_parts", i - 1), x), _BREAK).otherwise(""), x["part"]))
    sentences = F.filter(F.transform(F.split(F.array_join(marked, ""), _BREAK), strip), lambda s: s != "")
    return df.withColumn(name, sentences).drop("_parts", "_known")
