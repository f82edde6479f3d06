"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer reads words and writes symbols: insults, threats, targets, negators, reporters of speech, marks.
Further transducers read symbols and write symbols: one notes what a negator reaches, one what is reported speech, one
what is aimed at a target. Their composition feeds a last transducer that scores the sentence: which events it matched,
and with what weight. So "you idiot", "not an idiot" and "she called him an idiot" are told apart, and no word counts by itself.

The lexicon is a fixed list and word stems learned from labels; the weights of events are fitted to labels, from a prior
that holds where labels say nothing. Labels are read from a bounded sample of rows only.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm import texts as X

# At most this many labelled rows are learned from: those with the smallest hash of their id.
SAMPLE = 10_000
# A stem is learned from at least this many different toxic texts, if toxic texts are this many times as likely to have
# it as others, and if the likelihood ratio of that against chance is so large.
STEM_TEXTS = 6
STEM_ODDS = 5
STEM_RATIO = 30
STEM_LETTERS = 4
MAX_STEMS = 5000

INSULT, THREAT, TARGET, NEGATOR, REPORTER, QUOTE, PAUSE, WORD = "insult", "threat", "target", "negator", "reporter", "quote", "pause", "word"

# The word lists of the grammar, in English, German, French and Spanish.
LEXICON = {
    INSULT: """asshole bastard clown coward cretin disgusting dumb dumbass fool freak garbage idiot idiotic imbecile loser lunatic moron
        moronic parasite pathetic pig scum scumbag shithead stupid swine trash useless vermin worthless
        abschaum dummkopf idioten trottel versager vollidiot widerlich
        abruti connard crétin débile imbécile minable ordure pitoyable
        basura estúpido inútil patético escoria asqueroso""",
    THREAT: """kill murder strangle stab shoot destroy hurt beat burn hang slaughter
        töten umbringen erschießen verletzen tuer frapper étrangler matar golpear destruir""",
    TARGET: """you your yours yourself u he him she her they them these those people
        du dich dir dein deine ihr euch sie tu te toi vous ton votre usted tú ti ustedes""",
    NEGATOR: """not no never nobody neither nor none without cannot isn't aren't wasn't weren't don't doesn't didn't won't wouldn't can't
        nicht kein keine keinen nie niemals ne pas jamais aucun sin nunca ningún ninguna""",
    REPORTER: """said says say told tells called calls wrote writes claimed claims reported reports quoted alleged accused shouted
        sagte sagt nannte schrieb behauptete dit disait écrit appelé dijo dice llamó escribió""",
}

EVENTS = (
    "insult", "insult aimed", "insult negated", "insult reported",
    "threat", "threat aimed", "threat negated", "threat reported",
)
# Weight of a word of the fixed list that labels say nothing about, and of as many as make no more difference.
WORD_WEIGHT = 3.0
ENOUGH = 18.0
# Prior weight of each event per WORD_WEIGHT, and of none.
PRIOR = (2.6, 1.2, 0.3, 0.5, 0.3, 3.5, 0.0, 0.3)
PRIOR_BIAS = -3.0
PRIOR_STRENGTH = 1.0

_TOKENS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”„«»,]")
_WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_ENDS = re.compile(r"[.!?;\n]")

State = object
Step = Callable[[State, tuple], tuple[State, tuple]]


@dataclass
class Transducer:
    """A deterministic transducer: ``step`` gives the next state and the symbol written for the one read."""

    start: State
    step: Step


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that feeds what ``first`` writes to ``second``. States are pairs, found as they are reached."""
    known: dict[tuple, tuple] = {}

    def step(state, symbol):
        key = (state, symbol)
        if key not in known:
            a, middle = first.step(state[0], symbol)
            b, out = second.step(state[1], middle)
            known[key] = ((a, b), out)
        return known[key]

    return Transducer((first.start, second.start), step)


# A symbol is (kind, flags). Insults and threats collect flags on their way.


def _negation(reach: int = 3) -> Transducer:
    """A negator reaches the next ``reach`` words, up to a pause."""

    def step(left, symbol):
        kind, flags = symbol
        if kind == NEGATOR:
            return reach + 1, symbol
        if kind in (PAUSE, QUOTE):
            return 0, symbol
        if left and kind in (INSULT, THREAT):
            return left - 1, (kind, flags | {"negated"})
        return max(0, left - 1), symbol

    return Transducer(0, step)


def _reported() -> Transducer:
    """What follows a reporter is reported; if quoted, up to the end of the quotation."""

    def step(state, symbol):
        kind, flags = symbol
        if kind == REPORTER:
            return "reported", symbol
        if kind == QUOTE and state:
            return ("quoted" if state == "reported" else ""), symbol
        if state and kind in (INSULT, THREAT):
            return state, (kind, flags | {"reported"})
        return state, symbol

    return Transducer("", step)


def _aimed() -> Transducer:
    """An insult or threat is aimed once a target was named."""

    def step(seen, symbol):
        kind, flags = symbol
        if kind == TARGET:
            return True, symbol
        if seen and kind in (INSULT, THREAT):
            return seen, (kind, flags | {"aimed"})
        return seen, symbol

    return Transducer(False, step)


def _matched() -> Transducer:
    """Write the event of each insult and threat; a target named after one aims it, as a further event."""

    def step(open_, symbol):
        kind, flags = symbol
        if kind == TARGET and open_:
            return "", (f"{open_} aimed",)  # in addition to the plain event
        if kind not in (INSULT, THREAT):
            return open_, ()
        for flag in ("reported", "negated", "aimed"):
            if flag in flags:
                return "", (f"{kind} {flag}",)
        return kind, (kind,)

    return Transducer("", step)


def grammar() -> Transducer:
    return compose(compose(compose(_negation(), _reported()), _aimed()), _matched())


@dataclass
class Model:
    """The lexicon (kind and weight by word or stem) and the weights of events."""

    words: dict[str, tuple[str, float]]
    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = PRIOR
    bias: float = PRIOR_BIAS


def fixed_words() -> dict[str, tuple[str, float]]:
    return {w: (kind, WORD_WEIGHT) for kind, words in LEXICON.items() for w in words.split()}


class Matcher:
    """Runs the grammar over the sentences of a text that hold an insult or threat."""

    def __init__(self, model: Model) -> None:
        import ahocorasick

        self.words, self.stems = model.words, model.stems
        self.longest = max(map(len, model.stems), default=0)
        self.grammar = grammar()
        self.triggers = ahocorasick.Automaton()
        for word in [w for w, (kind, _) in model.words.items() if kind in (INSULT, THREAT)] + list(model.stems):
            self.triggers.add_word(word, len(word))
        self.triggers.make_automaton()

    def look_up(self, token: str) -> tuple[str, float]:
        """The lexicon transducer: the symbol of a token, by the whole word or its longest known stem."""
        token = token.replace("’", "'")
        if token in self.words:
            return self.words[token]
        if token in '"“”„«»':
            return QUOTE, 0.0
        if token == ",":
            return PAUSE, 0.0
        for n in range(min(len(token), self.longest), STEM_LETTERS - 1, -1):
            if token[:n] in self.stems:
                return INSULT, self.stems[token[:n]]
        return (NEGATOR, 0.0) if token.endswith("n't") else (WORD, 0.0)

    def match(self, text: str) -> list[tuple[int, int, str, float]]:
        """Start, end, event and weight of each matched sentence, with the weight of its words."""
        lower = text.lower()
        if len(lower) != len(text):  # places must be those of the text
            lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        hits = [end - n + 1 for end, n in self.triggers.iter(lower) if end == n - 1 or not lower[end - n].isalpha()]
        if not hits:
            return []
        ends = [m.start() for m in _ENDS.finditer(lower)]
        out, last = [], -1
        for hit in hits:
            i = bisect.bisect_left(ends, hit)
            if i == last:
                continue
            last = i
            a, b = ends[i - 1] + 1 if i else 0, ends[i] if i < len(ends) else len(lower)
            state, found, held = self.grammar.start, {}, 0.0
            for token in _TOKENS.findall(lower[a:b]):
                kind, weight = self.look_up(token)
                state, events = self.grammar.step(state, (kind, frozenset()))
                if kind in (INSULT, THREAT):
                    held = weight
                for event in events:
                    found[event] = found.get(event, 0.0) + held
            out += [(a, b, event, weight) for event, weight in found.items()]
        return out

    def features(self, matches: list[tuple[int, int, str, float]]) -> np.ndarray:
        """For each event, the weight of its sentences, up to ``ENOUGH``. An aimed event counts as a plain one too."""
        total = np.zeros(len(EVENTS))
        for _, _, event, weight in matches:
            total[EVENTS.index(event)] += weight
            if event.endswith(" aimed"):
                total[EVENTS.index(event.removesuffix(" aimed"))] += weight
        return np.minimum(total, ENOUGH) / WORD_WEIGHT


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many different texts of each label each stem occurs, in two halves of the texts.

    A copy of an earlier text would count its every word again: texts that share one of their two smallest shingle
    hashes with an earlier one are left out.
    """
    words, seen, halves = X.Words(), set(), [[Counter(), Counter()], [Counter(), Counter()]]
    texts = [0, 0]
    for batch in X.slices(batches):
        sets = X.shingle_sets(words, X.column(batch, "text"), 4)
        for text, shingles, label in zip(X.column(batch, "text").to_pylist(), sets, X.column(batch, "label").to_pylist(), strict=True):
            marks = set(shingles[:2].tolist())
            if marks & seen:
                continue
            seen |= marks
            half = sum(texts) % 2
            texts[label] += 1
            found = set()
            for word in set(_WORDS.findall(text.lower())):
                found.update(word[:n] for n in range(STEM_LETTERS, min(len(word), 12) + 1))
                if len(word) > 12:
                    found.add(word)
            halves[half][label].update(found)
    (clean_a, toxic_a), (clean_b, toxic_b) = halves
    rows = [("", texts[1], texts[0])]
    for stem, n in toxic_a.items():
        m = toxic_b.get(stem, 0)
        clean = clean_a.get(stem, 0) + clean_b.get(stem, 0)
        if min(n, m) >= STEM_TEXTS // 3 and n + m >= STEM_TEXTS and (n + m) * texts[0] >= STEM_ODDS * clean * texts[1]:
            rows.append((stem, n + m, clean))
    stems, toxic, clean = zip(*rows, strict=True)
    yield pa.record_batch({"stem": pa.array(stems), "toxic": pa.array(toxic, pa.int64()), "clean": pa.array(clean, pa.int64())})


def likelihood_ratio(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Twice the log likelihood of a stem's texts by label, over that by chance."""
    share = (toxic + clean) / (all_toxic + all_clean)
    terms = ((toxic, all_toxic * share), (clean, all_clean * share), (all_toxic - toxic, all_toxic * (1 - share)), (all_clean - clean, all_clean * (1 - share)))
    return 2 * sum(n * math.log(n / expected) for n, expected in terms if n)


def learn_stems(sample: DataFrame) -> dict[str, float]:
    """Stems that tell toxic texts, with their log odds. ``sample`` is small: one task reads it.

    Of stems that begin with each other, the most telling one is learned: a rare word's ending adds nothing, and a
    beginning that clean texts share says less. Of equally telling ones it is the longest.
    """
    rows = sample.repartition(1).mapInArrow(_count_stems, "stem string, toxic long, clean long").collect()
    texts = next(((r.toxic, r.clean) for r in rows if not r.stem), (0, 0))
    ratio = {r.stem: likelihood_ratio(r.toxic, r.clean, *texts) for r in rows if r.stem}
    found = {r.stem: (r.toxic, r.clean) for r in rows if r.stem and ratio[r.stem] >= STEM_RATIO}
    out: dict[str, float] = {}
    begun: set[str] = set()
    for stem in sorted(found, key=lambda s: (-ratio[s], -len(s), s)):
        starts = [stem[:n] for n in range(STEM_LETTERS, len(stem))]
        if stem not in begun and not any(s in out for s in starts) and len(out) < MAX_STEMS:
            toxic, clean = found[stem]
            out[stem] = math.log((toxic + 0.5) / (texts[0] + 1)) - math.log((clean + 0.5) / (texts[1] + 1))
            begun.update(starts)
    return out


def fit_weights(features: np.ndarray, labels: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Logistic regression by Newton's method, drawn to the prior."""
    prior = np.append(PRIOR, PRIOR_BIAS)
    x, w = np.column_stack((features, np.ones(len(features)))), prior.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + PRIOR_STRENGTH * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_STRENGTH * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w[:-1]), float(w[-1])


def held_out(id_column: str) -> Column:
    """Rows whose labels are never read: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled rows outside the held-out ones; without any, the prior alone."""
    known = labels.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where(~held_out("doc_id") & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = X.only(docs, id_column, text).join(F.broadcast(known), "doc_id").select("text", "label").persist()
    model = Model(fixed_words(), learn_stems(rows))
    for word, (kind, weight) in model.words.items():
        if kind in (INSULT, THREAT):  # a listed word of a learned stem weighs what labels say
            learned = [model.stems[word[:n]] for n in range(STEM_LETTERS, len(word) + 1) if word[:n] in model.stems]
            model.words[word] = (kind, max([weight, *learned]))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in X.slices(batches):
            found = [matcher.features(matcher.match(t)) for t in X.column(batch, "text").to_pylist()]
            yield pa.record_batch({"f": pa.array(found, pa.list_(pa.float64())), "label": X.column(batch, "label")})

    table = rows.mapInArrow(featured, "f array<double>, label int").toArrow()
    rows.unpersist()
    if table.num_rows:
        model.weights, model.bias = fit_weights(np.asarray(table["f"].to_pylist()), table["label"].to_numpy().astype(float))
    return model


def score_texts(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, score, predicted, matches), one for each row of ``docs``.

    ``score`` is the probability that a text is toxic, ``predicted`` is 1 from 0.5 on, and ``matches`` are the matched
    sentences: start, end, event and weight. Whole texts are read. A null or empty text matches nothing and has the
    score of no match. Each row is scored on its own. An empty table gives an empty result; other columns are not read.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("event", pa.string()), ("weight", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, weights = Matcher(model), np.asarray(model.weights)
        for batch in X.slices(batches):
            matches = [matcher.match(t) for t in X.column(batch, "text").to_pylist()]
            odds = np.asarray([matcher.features(m) @ weights + model.bias for m in matches])
            score = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            yield pa.record_batch(
                {
                    "doc_id": X.column(batch, "doc_id"),
                    "score": pa.array(score),
                    "predicted": pa.array((score >= 0.5).astype(np.int32)),
                    "matches": pa.array([[dict(zip(("start", "end", "event", "weight"), x, strict=True)) for x in m] for m in matches], kind),
                }
            )

    schema = "doc_id long, score double, predicted int, matches array<struct<start:long,end:long,event:string,weight:double>>"
    return X.only(docs, id_column, text).mapInArrow(run, schema)
