"""Column builders for tokens, sentences, lexicon sentiment and keyword tags.

Everything works within a row: no join, no shuffle, no Python worker. Where a dictionary is asked for, a mapping of
up to ``MAX_ENTRIES`` words will do, or a function from a word to its entry; ``operators.dictionary`` makes one from a
table of any size.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from newsloom.dictionaries import BOOSTERS, ENGLISH_STOPWORDS, IDIOMS, NEGATIONS, WEAKENING
from newsloom.functions.lookup import MAX_ENTRIES, let, lookup
from newsloom.functions.parse import WS, empty_list, strip

WORD = r"[\p{L}\p{N}_]+"
# Words, contraction endings and single punctuation marks.
_ENDING = r"n't|'(?:s|re|ve|ll|d|m)\b"
TOKEN = rf"{_ENDING}|{WORD}|[^\s\p{{L}}\p{{N}}_]"
# Tokens of two or more characters, and of one or more: without punctuation marks.
_SPOKEN = rf"{_ENDING}|[\p{{L}}\p{{N}}_]{{2,}}"
_SPOKEN_OR_SINGLE = rf"{_ENDING}|{WORD}"
TERM_WORD = r"[\p{L}\p{N}_$#]+"


def words(c: Column) -> Column:
    """Lower-case words, without punctuation."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def tokens(c: Column, pattern: str = TOKEN) -> Column:
    """Lower-case words and punctuation marks, with contractions taken apart."""
    apart = F.replace(F.lower(c), F.lit("n't"), F.lit(" n't "))
    return F.regexp_extract_all(apart, F.lit(pattern), F.lit(0))


Dictionary = Mapping | Callable[[Column], Column]


def _looked_up(dictionary: Dictionary, value_type: str) -> Callable[[Column], Column]:
    return dictionary if callable(dictionary) else lookup(dictionary, value_type)


def preprocess(
    c: Column, stopwords: Iterable[str] | Callable[[Column], Column] = (), base_forms: Dictionary | None = None
) -> Column:
    """Tokens without stopwords, each replaced by its base form (lemma or stem) if it has one.

    ``stopwords`` may be a function that gives null for all other words.
    """
    kept = tokens(F.coalesce(c, F.lit("")))
    if callable(stopwords):
        kept = F.filter(kept, lambda t: stopwords(t).isNull())
    elif stop := sorted(set(stopwords)):
        kept = F.filter(kept, lambda t: ~t.isin(stop))
    if base_forms:
        base = _looked_up(base_forms, "string")
        kept = F.transform(kept, lambda t: F.coalesce(base(t), t))
    return kept


def preprocess_text(
    c: Column, stopwords: Iterable[str] | Callable[[Column], Column] = (), base_forms: Dictionary | None = None
) -> Column:
    return F.array_join(preprocess(c, stopwords, base_forms), " ")


# Constants of the published rule-based scorer (Hutto & Gilbert 2014).
NORMALISER = 15.0
NEGATED = -0.74
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MAX_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
# Of its rules on words around a word. "never so" and "never this" raise, "least" negates but for "at
# least" and "very least", and what follows "but" counts for more than what comes before.
NEVER_SO, NEVER_WITHIN_THREE = 1.5, 1.25
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
RULE_WORDS = ("never", "so", "this", "least", "at", "very", "but")


@dataclass(frozen=True)
class Lexicon:
    """Word valences with the words that strengthen or negate what follows, and the text cleaning.

    With ``rules``, the published rules on several words hold as well: "never so", "least", "but", ``idioms`` of two or
    three words, which have a valence of their own, and boosters of two words.
    """

    valence: Mapping[str, float]
    boosters: Mapping[str, float] = field(default_factory=dict)
    negations: tuple[str, ...] = ()
    stopwords: tuple[str, ...] = ()
    base_forms: Mapping[str, str] = field(default_factory=dict)
    rules: bool = False
    idioms: Mapping[str, float] = field(default_factory=dict)

    def pairs(self) -> list[str]:
        """Boosters of two words."""
        return sorted(b for b in self.boosters if " " in b)

    def named(self) -> set[str]:
        """Words that a rule asks for by name."""
        return {*RULE_WORDS, *(w for phrase in [*self.idioms, *self.pairs()] for w in phrase.split())} if self.rules else set()

    def terms(self) -> dict[str, dict]:
        """What a token as it stands in the text means; tokens that mean nothing are left out."""
        meaning, named = {}, self.named()
        for token in {*self.valence, *self.boosters, *self.negations, *self.base_forms, *self.stopwords, *named}:
            word = self.base_forms.get(token, token)
            term = {
                "v": self.valence.get(word),
                "b": self.boosters.get(word),
                "n": word in self.negations,
                "drop": token in self.stopwords or len(word) < 2,
            }
            if self.rules:
                term["w"] = word if word in named else None
            if term["drop"] or term["n"] or term["v"] is not None or term["b"] is not None or term.get("w"):
                meaning[token] = term
        return meaning

    def spoken(self, c: Column) -> Column:
        """Tokens that can be words once they have their base form: longer than one character."""
        singles = sorted(t for t, word in self.base_forms.items() if len(t) < 2 <= len(word))
        if not singles:
            return tokens(c, _SPOKEN)
        found = tokens(c, _SPOKEN_OR_SINGLE)
        return F.filter(found, lambda t: (F.length(t) > 1) | t.isin(singles))

    def count(self, c: Column, mark: str) -> Column:
        """How often a punctuation mark occurs."""
        if mark in self.stopwords:
            return F.lit(0)
        return F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))


def english_lexicon(
    valence: Mapping[str, float], base_forms: Mapping[str, str] | None = None
) -> Lexicon:
    """Word valences with the published English boosters, negations, idioms and stopwords, and all rules."""
    return Lexicon(valence, BOOSTERS, NEGATIONS, ENGLISH_STOPWORDS, base_forms or {}, True, IDIOMS)


def read_dictionary(spark: SparkSession, path: str, value_type: str = "double") -> dict:
    """A dictionary from a tab-separated file of words and values; further columns are ignored.

    That is how valence lists and lemma lists (``value_type="string"``) are commonly published.
    """
    rows = (
        spark.read.option("sep", "\t").option("quote", "")
        .schema(f"word string, value {value_type}").csv(path)
        .where("word IS NOT NULL AND value IS NOT NULL")
        .take(MAX_ENTRIES + 1)
    )
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} words in {path}")
    return {r.word: r.value for r in rows}


def _with_context(terms: Column, i: Column, own: Column) -> Column:
    """Valence of a word after the up to three words before it had their say."""

    def after(value: Column, distance: int) -> Column:
        before = F.get(terms, i - distance)
        boost = before["b"] * DISTANCE_DAMPING[distance - 1] * F.when(value < 0, -1.0).otherwise(1.0)
        raised = value + F.coalesce(boost, F.lit(0.0))
        said = before.isNotNull() & before["v"].isNull()
        return F.when(said, raised * F.when(before["n"], NEGATED).otherwise(1.0)).otherwise(value)

    return let(after(own, 1), lambda v: let(after(v, 2), lambda w: after(w, 3)))


def _with_rules(terms: Column, i: Column, own: Column, lexicon: Lexicon) -> Column:
    """The same with the rules on several words."""

    def at(distance: int) -> Column:
        return F.when(i >= distance, F.get(terms, i - distance)) if distance > 0 else F.get(terms, i - distance)

    def word(distance: int) -> Column:
        return F.coalesce(at(distance)["w"], F.lit(""))

    def so(distance: int) -> Column:
        return word(distance).isin("so", "this")

    def unknown(distance: int) -> Column:
        return (i >= distance) & at(distance)["v"].isNull()

    def phrase(first: int, last: int) -> Column:
        return F.concat_ws(" ", *[word(d) for d in range(first, last - 1, -1)])

    def after(value: Column, distance: int) -> Column:
        before = at(distance)
        boost = F.coalesce(before["b"] * DISTANCE_DAMPING[distance - 1], F.lit(0.0)) * F.when(value < 0, -1.0).otherwise(1.0)
        negated = F.when(F.coalesce(before["n"], F.lit(False)), NEGATED).otherwise(1.0)
        if distance == 2:
            negated = F.when((word(2) == "never") & so(1), NEVER_SO).otherwise(negated)
        if distance == 3:
            negated = F.when(((word(3) == "never") & so(2)) | so(1), NEVER_WITHIN_THREE).otherwise(negated)
        return F.when(unknown(distance), (value + boost) * negated).otherwise(value)

    def idiom(value: Column) -> Column:
        """An idiom that the word is in, or that ends before it, takes the place of its valence; one that it begins too."""
        valences = F.create_map(*[F.lit(x) for pair in sorted(lexicon.idioms.items()) for x in pair])
        back = [F.try_element_at(valences, phrase(*ends)) for ends in ((1, 0), (2, 0), (2, 1), (3, 1), (3, 2))]
        ahead = [F.try_element_at(valences, phrase(0, last)) for last in (-2, -1)]
        return F.when(unknown(3), F.coalesce(*ahead, *back, value)).otherwise(value)

    def weakened(value: Column) -> Column:
        pair = phrase(3, 2).isin(lexicon.pairs()) | phrase(2, 1).isin(lexicon.pairs())
        return F.when(unknown(3) & pair, value + WEAKENING).otherwise(value)

    def least(value: Column) -> Column:
        only = (i < 2) | ~word(2).isin("at", "very")
        return F.when((word(1) == "least") & at(1)["v"].isNull() & only, value * NEGATED).otherwise(value)

    steps = [lambda v: after(v, 1), lambda v: after(v, 2), lambda v: after(v, 3)]
    steps += [idiom] * bool(lexicon.idioms) + [weakened] * bool(lexicon.pairs()) + [least]

    def run(value: Column, rest: list) -> Column:
        return let(rest[0](value), lambda v: run(v, rest[1:])) if rest else value

    return run(own, steps)


def _emphasis(shouts: Column, asks: Column) -> Column:
    """Weight of exclamation and question marks."""
    return F.least(shouts, F.lit(MAX_EXCLAMATIONS)) * EXCLAMATION + F.when(
        asks > 1, F.when(asks <= MAX_QUESTIONS, asks * QUESTION).otherwise(MANY_QUESTIONS)
    ).otherwise(0.0)


def _compound(total: Column) -> Column:
    return F.round(total / F.sqrt(total * total + NORMALISER), 4)


def lexicon_score(c: Column, lexicon: Lexicon, terms: Callable[[Column], Column] | None = None) -> Column:
    """Compound sentiment in [-1, 1] of a text column; null text scores zero.

    The text is scored as ``preprocess`` leaves it. Each token is looked up once, in a dictionary
    that already knows about stopwords and base forms, and the context rules see only the entries. ``terms`` may take
    the place of that dictionary: a function from a token to what ``Lexicon.terms`` holds for it.
    """
    c = F.coalesce(c, F.lit(""))
    kind = "struct<v:double,b:double,n:boolean,drop:boolean" + (",w:string>" if lexicon.rules else ">")
    term = terms or lookup(lexicon.terms(), kind)
    spoken = F.filter(
        F.transform(lexicon.spoken(c), term), lambda t: ~F.coalesce(t["drop"], F.lit(False))
    )

    def of_terms(terms: Column) -> Column:
        def in_context(t: Column, i: Column) -> Column:
            value = _with_rules(terms, i, t["v"], lexicon) if lexicon.rules else _with_context(terms, i, t["v"])
            return F.when(t["v"].isNotNull() & t["b"].isNull(), value).otherwise(0.0)

        scored = F.transform(terms, in_context)
        if lexicon.rules:
            but = F.array_position(F.transform(terms, lambda t: F.coalesce(t["w"], F.lit(""))), "but")
            weight = lambda at, i: F.when((at == 0) | (at == i + 1), 1.0).when(i + 1 < at, BEFORE_BUT).otherwise(AFTER_BUT)
            scored = let(F.struct(scored.alias("x"), but.alias("at")), lambda p: F.transform(p["x"], lambda x, i: x * weight(p["at"], i)))
        return F.round(F.aggregate(scored, F.lit(0.0), lambda a, x: a + x), 9)

    parts = F.struct(
        let(spoken, of_terms).alias("total"),
        lexicon.count(c, "!").alias("shouts"),
        lexicon.count(c, "?").alias("asks"),
    )

    def raised(p: Column) -> Column:
        return p["total"] + F.signum(p["total"]) * _emphasis(p["shouts"], p["asks"])

    return let(let(parts, raised), _compound)


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score >= 0.05, "Positive").when(score <= -0.05, "Negative").otherwise("Neutral")
    )


def average_of_nonzero(a: Column, b: Column) -> Column:
    """Mean of two scores, or the one that is not zero."""
    return (
        F.when((a != 0) & (b != 0), (a + b) / 2).when(a != 0, a).when(b != 0, b).otherwise(0.0)
    )


def article_score(title: Column, description: Column, lexicon: Lexicon) -> Column:
    """Sentiment of an article from its title and its description."""
    return let(
        F.struct(
            lexicon_score(title, lexicon).alias("t"), lexicon_score(description, lexicon).alias("d")
        ),
        lambda s: average_of_nonzero(s["t"], s["d"]),
    )


def split_sentences(c: Column) -> Column:
    """Sentences that end in ``.``, ``!`` or ``?`` before whitespace; blank ones are dropped."""
    parts = F.split(strip(F.coalesce(c, F.lit(""))), f"(?<=[.!?]){WS}+")
    return F.filter(parts, lambda s: s != "")


def normalize_sentence(c: Column, method: str = "regex") -> Column:
    """Lower case with single blanks; ``tokens`` and ``hybrid`` also set punctuation apart."""
    if method == "regex":
        return F.regexp_replace(F.lower(strip(c)), f"{WS}+", " ")
    spaced = F.array_join(tokens(c), " ")
    if method == "tokens":
        return spaced
    if method == "hybrid":
        return strip(F.regexp_replace(spaced, f"{WS}+", " "))
    raise ValueError(f"unknown method {method}")


def keyword_tickers(title: Column, keywords: Mapping[str, Iterable[str]] | Callable[[Column], Column]) -> Column:
    """Sorted distinct tickers whose keywords are words of the title.

    ``keywords`` may be a function from a word to its ticker. A keyword of several words never equals a single word, so it never matches.
    """
    by_word = keywords if callable(keywords) else {w.lower(): t.upper() for t, ws in keywords.items() for w in ws}
    ticker = _looked_up(by_word, "string")
    found = F.filter(F.transform(words(title), ticker), lambda t: t.isNotNull())
    return F.coalesce(F.array_sort(F.array_distinct(found)), empty_list())


def _search_words(search_terms: str) -> list[str]:
    return [t.strip().lower() for t in re.split(" OR | AND |,", search_terms)]


def prefix_terms(
    title: Column,
    search_terms: str,
    stems: Mapping[str, str] | None = None,
    return_search_terms: bool = True,
) -> Column:
    """Search terms whose stem starts a stemmed title word; all of them if none matches.

    With ``return_search_terms=False`` the matching title words, or nothing.
    """
    stems = stems or {}
    asked = _search_words(search_terms)
    stem = lookup(stems, "string") if stems else (lambda w: F.lit(None).cast("string"))
    pairs = F.array(
        *[F.struct(F.lit(t).alias("term"), F.lit(stems.get(t, t)).alias("stem")) for t in asked]
    )
    title_words = words(F.coalesce(title, F.lit("None")))

    if return_search_terms:
        stemmed = F.transform(title_words, lambda w: F.coalesce(stem(w), w))
        matched = let(
            stemmed,
            lambda ws: F.transform(
                F.filter(pairs, lambda p: F.exists(ws, lambda w: w.startswith(p["stem"]))),
                lambda p: p["term"],
            ),
        )
        otherwise = F.array(*[F.lit(t) for t in asked])
    else:
        matched = F.filter(
            title_words,
            lambda w: F.exists(pairs, lambda p: F.coalesce(stem(w), w).startswith(p["stem"])),
        )
        otherwise = empty_list()
    found = F.array_sort(F.array_distinct(matched))
    return let(found, lambda f: F.when(F.size(f) > 0, f).otherwise(otherwise))


def stem_terms(
    title: Column, search_terms: str, stems: Mapping[str, str] | None = None
) -> Column:
    """Search terms found in a title as words (``$btc`` counts as ``btc``) or by equal stems."""
    stems = stems or {}
    asked = _search_words(search_terms)
    of_stem = {stems.get(t, t): t for t in asked}
    # A title word is known if it is a term, or if its stem is the stem of one.
    known = {w: of_stem[s] for w, s in stems.items() if s in of_stem}
    known |= {s: t for s, t in of_stem.items() if stems.get(s, s) == s}
    known |= {t: t for t in asked}
    term = lookup(known, "string")
    found = F.transform(
        F.regexp_extract_all(F.lower(title), F.lit(TERM_WORD), F.lit(0)),
        lambda w: term(F.regexp_replace(w, r"^[$#]+", "")),
    )
    return F.coalesce(
        F.array_sort(F.array_distinct(F.filter(found, lambda t: t.isNotNull()))), empty_list()
    )
