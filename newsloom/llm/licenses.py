"""Licence scan: Aho-Corasick finds identifier tags and notice phrases, and a shunting-yard parser evaluates the
licence expressions that follow a tag.

Words are runs of letters and digits (any byte from 0x80 on counts as a letter), A-Z taken as a-z. A text is brought
to its words with single blanks between by byte translation, so one automaton finds phrases however they are spaced,
and the number of blanks before a hit is the place of its first word.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from newsloom.llm import texts as X

# The phrases of the contract, and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notices of common licences.
NOTICE_PHRASES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache-2",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "released into the public domain": "public-domain",
    "cc0": "cc0",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "all rights reserved": "all-rights-reserved",
}
# The tags that an identifier or expression follows, as words.
TAGS = ("spdx license identifier", "license expression", "license identifier")
# Identifiers of expressions, lower case, and their labels.
IDENTIFIERS = {
    "mit": "mit", "apache-2.0": "apache-2", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd", "0bsd": "bsd", "isc": "isc",
    "gpl-2.0": "gpl-2", "gpl-2.0-only": "gpl-2", "gpl-2.0-or-later": "gpl-2", "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3",
    "gpl-3.0-or-later": "gpl-3", "lgpl-2.1": "lgpl", "lgpl-2.1-only": "lgpl", "lgpl-2.1-or-later": "lgpl", "lgpl-3.0": "lgpl",
    "lgpl-3.0-only": "lgpl", "lgpl-3.0-or-later": "lgpl", "agpl-3.0": "agpl", "agpl-3.0-only": "agpl", "agpl-3.0-or-later": "agpl",
    "mpl-2.0": "mpl-2", "cc0-1.0": "cc0", "cc-by-4.0": "cc-by", "cc-by-sa-4.0": "cc-by-sa", "cc-by-nc-4.0": "cc-by-nc",
    "cc-by-nd-4.0": "cc-by-nd", "unlicense": "public-domain",
}
# How freely a text under a label may be used, from 0 to 1; a phrase's label without a figure counts as UNKNOWN.
FREEDOM = {
    "mit": 1.0, "apache-2": 1.0, "bsd": 1.0, "isc": 1.0, "public-domain": 1.0, "cc0": 1.0, "cc-by": 0.9, "mpl-2": 0.7, "cc-by-sa": 0.6,
    "lgpl": 0.5, "gpl": 0.4, "gpl-2": 0.4, "gpl-3": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "all-rights-reserved": 0.0,
}
UNKNOWN = 0.5

_WORD = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Bytes of words as themselves, A-Z as a-z, all others as blanks.
_AS_WORDS = bytes(_LOWER[b] if _LOWER[b] in _WORD else 32 for b in range(256))
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


@dataclass
class Expression:
    """The value of a licence expression: how free it is, and the labels it names."""

    freedom: float
    labels: frozenset[str] = field(default_factory=frozenset)


def _value(identifier: str) -> Expression:
    label = IDENTIFIERS.get(identifier.rstrip("+"), identifier)
    return Expression(FREEDOM.get(label, UNKNOWN), frozenset([label]))


def _beginning(tokens: Iterable[str]) -> list[str]:
    """The longest beginning of the tokens that is a valid expression; no token behind the first misplaced one is read."""
    read, end, depth, operand_next = [], 0, 0, True
    for token in tokens:
        operator = token in _PRECEDENCE
        if (operator or token == ")") == operand_next or (token == "(" and not operand_next):
            break
        if not operand_next and not operator and token != ")":
            break
        if token == ")" and not depth:
            break
        read.append(token)
        depth += (token == "(") - (token == ")")
        operand_next = operator or token == "("
        if not operand_next and not depth:
            end = len(read)
    return read[:end]


def evaluate(tokens: Iterable[str]) -> tuple[Expression | None, int]:
    """The value of the longest valid expression that begins the tokens, and how many tokens it has.

    Shunting-yard: operators wait on a stack until one of lower precedence, a closing bracket or the end applies them.
    ``or`` lets the reader choose and is as free as the freer side, ``and`` binds to both and is as free as the less
    free, and ``with`` adds an exception to the licence before it and leaves it as free as it was. ``with`` binds
    closest, then ``and``. Without a valid expression the value is None. An expression may have any number of tokens: it
    is read once and evaluated once, and of two sets of labels the smaller is added to the larger.
    """
    tokens = _beginning(tokens)
    if not tokens:
        return None, 0
    values: list[tuple[float, set[str]]] = []
    waiting: list[str] = []

    def apply(operator: str) -> None:
        right, left = values.pop(), values.pop()
        if operator == "with":
            values.append(left)
            return
        small, large = sorted((left[1], right[1]), key=len)
        large |= small
        values.append(((max if operator == "or" else min)(left[0], right[0]), large))

    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                apply(waiting.pop())
            waiting.pop()
        elif token in _PRECEDENCE:
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[token]:
                apply(waiting.pop())
            waiting.append(token)
        else:
            one = _value(token)
            values.append((one.freedom, set(one.labels)))
    while waiting:
        apply(waiting.pop())
    freedom, labels = values.pop()
    return Expression(freedom, frozenset(labels)), len(tokens)


def as_words(text: bytes) -> bytes:
    """The words of a text, with single blanks between and around them."""
    return b" " + b" ".join(text.translate(_AS_WORDS).split()) + b" "


def automaton(phrases: Mapping[str, tuple]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, value in phrases.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, value))
    found.make_automaton()
    return found


class Line:
    """The tokens of one line, and for any place the longest valid expression that begins there, without reading on.

    Whether two tokens may follow each other depends on them alone, so where the next misplaced token is and where a
    bracket closes that was not opened are found for all places at once.
    """

    def __init__(self, text: str, start: int, end: int) -> None:
        found = [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]
        self.tokens = [f[0] for f in found]
        self.starts, self.ends = [f[1] for f in found], [f[2] for f in found]
        n, depth = len(found), 0
        self.depth = [depth := depth + (t == "(") - (t == ")") for t in self.tokens]
        # The next place whose token may not follow the one before, and the next of smaller depth, after each place.
        self.breaks, self.falls = [n] * (n + 1), [n] * (n + 1)
        waiting: list[int] = []
        for i in range(n - 1, -1, -1):
            self.breaks[i] = i + 1 if i + 1 < n and not _may_follow(self.tokens[i], self.tokens[i + 1]) else self.breaks[i + 1]
            while waiting and self.depth[waiting[-1]] >= self.depth[i]:
                waiting.pop()
            self.falls[i] = waiting[-1] if waiting else n
            waiting.append(i)
        self.first_fall = next((i for i, d in enumerate(self.depth) if d < 0), n)
        # Where an expression may end, by depth.
        self.closes: dict[int, list[int]] = {}
        for i, t in enumerate(self.tokens):
            if t != "(" and t not in _PRECEDENCE:
                self.closes.setdefault(self.depth[i], []).append(i)

    def expression(self, at: int) -> tuple[list[str], int]:
        """The tokens of the longest valid expression that begins at a place, none if there is none, and where it ends."""
        i = bisect.bisect_right(self.ends, at)
        if i == len(self.tokens):
            return [], at
        first = self.tokens[i][max(0, at - self.starts[i]) :]
        if first in _PRECEDENCE or first == ")":
            return [], at
        base = self.depth[i - 1] if i else 0
        limit = min(self.breaks[i + 1] if i + 1 < len(self.tokens) else i + 1, self.falls[i - 1] if i else self.first_fall)
        if i + 1 < len(self.tokens) and not _may_follow(first, self.tokens[i + 1]):
            limit = i + 1
        ends = self.closes.get(base, [])
        last = bisect.bisect_left(ends, limit) - 1
        # The first token may be the rest of an operator's word, and then closes what its word does not.
        if last < 0 or ends[last] < i:
            return ([first], self.ends[i]) if first != "(" and limit > i and self.depth[i] == base else ([], at)
        return [first, *self.tokens[i + 1 : ends[last] + 1]], self.ends[ends[last]]


def _may_follow(token: str, next_: str) -> bool:
    """Whether an operator or closing bracket follows an operand or closing bracket, and an operand or opening one anything else."""
    operand_next = token in _PRECEDENCE or token == "("
    return operand_next != (next_ in _PRECEDENCE or next_ == ")")


class Scanner:
    """Finds base phrases, notices and tagged expressions in one text at a time."""

    def __init__(self, base: Mapping[str, str], notices: Mapping[str, str]) -> None:
        self.phrases = automaton(
            {t: ("tag", t) for t in TAGS} | {p: ("notice", label) for p, label in notices.items()} | {p: ("base", label) for p, label in base.items()}
        )
        self.tag = re.compile("|".join(r"[^a-z0-9]+".join(t.split()) for t in TAGS))

    def expressions(self, text: str) -> list[Expression]:
        """The expressions behind the tags of a text; one reaches to the end of its line at most.

        A tag within an expression that is read already belongs to that one. A line of any length is tokenised once.
        """
        lower, out, end, line = text.lower(), [], -1, None
        done = -1
        for hit in self.tag.finditer(lower):
            if end < hit.end():
                end = lower.find("\n", hit.end())
                end, line = end if end >= 0 else len(lower), None
            if hit.start() < done:
                continue
            line = line or Line(lower, hit.end(), end)
            tokens, stop = line.expression(hit.end())
            if tokens:
                value, _ = evaluate(tokens)
                out.append(value)
                done = stop
        return out

    def scan(self, data: bytes) -> tuple:
        words = as_words(data)
        n_words = words.count(b" ") - 1 if len(words) > 2 else 0
        # One character per byte, so places in the string are places in the bytes.
        plain = words.decode("latin-1")
        places, base, longest, tagged = [], set(), {}, False
        for end, (length, (kind, value)) in self.phrases.iter(plain):
            start = end - length + 1
            if kind == "tag":
                tagged = True
                continue
            if kind == "base":
                base.add(value)
                places.append(start)
            # Of notices that begin at the same word, the longest says most; it comes last.
            longest[start] = value
        labels = base | set(longest.values())
        freedom = [FREEDOM.get(value, UNKNOWN) for value in labels]
        if tagged:
            for value in self.expressions(data.decode("utf-8", "replace")):
                labels |= value.labels
                freedom.append(value.freedom)
        starts = [plain.count(" ", 0, p) for p in (min(places), max(places))] if places else [None, None]
        return n_words, len(places), *starts, ",".join(sorted(base)), ",".join(sorted(labels)), min(freedom, default=UNKNOWN)


def scan_licenses(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text",
    base: Mapping[str, str] = BASE_PHRASES, notices: Mapping[str, str] = NOTICE_PHRASES,
) -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one for each row of ``docs``.

    ``n_base`` counts all places at which the words of a ``base`` phrase stand consecutively; ``first_word`` and
    ``last_word`` are the smallest and largest of their starts, counted in words from 0, or null. ``labels`` adds those
    of ``notices`` and of tagged expressions to the base ones. ``score`` says how freely the text may be used, 0 to 1:
    the least of its notices and expressions, or ``UNKNOWN`` without any.

    A null, empty or wordless text has no words and no labels. Each row is scanned on its own, so rows that repeat an
    id or have none are results of their own. An empty table gives an empty result. Other columns are not read.
    """
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
    base, notices = dict(base), dict(notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for batch in X.slices(batches):
            found = [scanner.scan(t.as_buffer().to_pybytes()) for t in X.column(batch, "text")]
            columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            yield pa.record_batch({"doc_id": X.column(batch, "doc_id")} | dict(zip(names, columns, strict=True)))

    return X.only(docs, id_column, text).mapInArrow(run, schema)
