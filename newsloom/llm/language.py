"""Language identification by Bayesian evidence fusion.

The posterior of a language is proportional to the product of

* the likelihood of the text, by a smoothed model of byte trigrams per language,
* the likelihood of the declared language (a metadata column, or the ``lang`` attribute of markup), from how often each
  language is declared as another in the whole table,
* the prior of the host, smoothed hierarchically: a host's counts are drawn to those of its address suffix, and a
  suffix's to those of the table.

The counts behind declarations and priors are grouped aggregations over all rows, each row counted under the language
its text suggests, and a row's own count is taken out before it is judged.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm import texts as X
from newsloom.session import stored

# The text model is fitted to at most this many labelled rows of each language, those with the smallest hash of their id.
SAMPLE = 4000
# A language is known from this many labelled rows of the whole table on.
LEAST_ROWS = 5
SLOTS = 1 << 14
# Bytes of text scored at a time.
SLICE = 1 << 17
# Trigrams of a text are not independent: a text weighs as much as this many of them at most.
WEIGHT = 50
# Strength of the priors that counts are drawn to, in rows.
TO_SUFFIX, TO_TABLE, TO_EVEN = 20.0, 50.0, 1.0
# A text whose mean log likelihood per trigram is, in every language, further below the mean of that language's own
# sample, in standard deviations, is in no known language.
FAR = 20.0

# Bytes of letters: a-z (A-Z are lowered) and all of multi-byte characters; everything else is one blank.
_CODE = np.zeros(256, np.uint8)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)


def trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the trigrams of each text and where each text's begin. Runs of blanks are one; blanks alone are none."""
    code = _CODE[data]
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] > 0) | (code[:-1] > 0) | (text[1:] != text[:-1])
    code, text = code[keep].astype(np.uint64), text[keep]
    n = max(0, len(code) - 2)
    whole = (text[:n] == text[2:]) & ((code[:n] > 0) | (code[1 : n + 1] > 0))
    x = (code[:n] * np.uint64(155) + code[1 : n + 1]) * np.uint64(155) + code[2 : n + 2]
    slots = (X.mix(x[whole] + np.uint64(1)) & np.uint64(SLOTS - 1)).astype(np.int64)
    return slots, np.searchsorted(text[:n][whole], np.arange(len(bounds)))


@dataclass
class TextModel:
    """Log likelihoods by slot and language; mean and deviation of what each language's sample has in its own language."""

    languages: list[str]
    table: np.ndarray
    mean: np.ndarray | float
    deviation: np.ndarray | float

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The sum of log likelihoods per language and the number of trigrams, for each text."""
        slots, first = trigrams(*X.utf8(texts))
        counts = np.diff(first)
        sums = np.zeros((len(counts), len(self.languages)))
        filled = np.flatnonzero(counts)
        if len(filled):
            sums[filled] = np.add.reduceat(self.table[slots], first[filled], axis=0)
        return sums, counts


def primary(code: Column) -> Column:
    """The primary part of a language tag, lower case; null for none."""
    return F.nullif(F.lower(F.regexp_extract(F.trim(code), r"^([A-Za-z]{2,8})(?:[-_].*)?$", 1)), F.lit(""))


def markup_language(html: Column) -> Column:
    """The ``lang`` attribute of the html element."""
    return primary(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([^\s"'>]+)""", 1))


_NO_TEXT = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|</?[a-z!?](?:(?>(?:[^>"']+|"[^"]*"|'[^']*')*)>|[^>]*(?:>|\Z))""", re.S | re.I
)


def without_markup(html: str) -> str:
    """The text of a page: blanks for tags, comments, scripts and styles; character references as their characters."""
    return unescape(_NO_TEXT.sub(" ", html))


def page_text(html: Column) -> Column:
    """``without_markup`` of each page; an empty text for null."""

    def run(pages: pa.Array) -> pa.Array:
        return pa.array([without_markup(x.as_py() or "") for x in pages], pa.string())

    return F.arrow_udf(run, T.StringType())(html)


def host_of(url: Column) -> Column:
    """The host of an address, lower case, without user and port; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def sample_by_language(rows: DataFrame, sample: int, least: int = LEAST_ROWS) -> DataFrame:
    """Rows (lang, text): of each language that ``least`` rows declare, the ``sample`` rows of smallest hash, or all.

    Rows are counted over the whole table. Hashes are then compared with the share that a language's sample is of its
    rows, so few more rows than the sample are put in order, however many there are.
    """
    hashed = rows.where("lang is not null").select("lang", "doc_id", "text", F.xxhash64("doc_id").alias("hash"))
    known = hashed.groupBy("lang").agg(F.count("*").alias("n"), F.min("hash").alias("lowest")).where(F.col("n") >= least)
    # A fifth more than the sample, and the smallest hash whatever its place: rows may share an id.
    reach = -(2.0**63) + F.least(F.lit(1.0), (1.2 * sample + 100) / F.col("n")) * 2.0**64
    known = stored(known.select(F.col("lang").alias("of"), "lowest", reach.alias("reach")), "languages")
    near = hashed.join(known, hashed["lang"] == known["of"]).where((F.col("hash").cast("double") <= F.col("reach")) | (F.col("hash") == F.col("lowest")))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id", F.xxhash64("text"), "text"))
    return near.select("lang", "text", first.alias("place")).where(F.col("place") <= sample).select("lang", "text")


def fit_text_model(rows: DataFrame, sample: int = SAMPLE) -> TextModel:
    """Fit to rows (doc_id, text, lang): counts of slots by language, over at most ``sample`` rows of each language.

    Every language that ``LEAST_ROWS`` rows of the whole table declare is known, at any size of the table.
    """
    few = sample_by_language(rows, sample).repartition("lang")

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in X.slices(batches, size=SLICE):
            slots, first = trigrams(*X.utf8(X.column(batch, "text")))
            for i, lang in enumerate(X.column(batch, "lang").to_pylist()):
                sums[lang] = sums.get(lang, 0) + np.bincount(slots[first[i] : first[i + 1]], minlength=SLOTS)
        for lang, total in sums.items():
            yield pa.record_batch({"lang": pa.array([lang]), "counts": pa.array([total.astype("<f8").tobytes()], pa.binary())})

    total: dict[str, np.ndarray] = {}
    for row in few.mapInArrow(count, "lang string, counts binary").toLocalIterator():
        total[row.lang] = total.get(row.lang, 0) + np.frombuffer(row.counts, "<f8")
    languages = sorted(total)
    if not languages:
        return TextModel(["und"], np.zeros((SLOTS, 1)), 0.0, 1.0)
    counts = np.column_stack([total[x] for x in languages])
    table = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * SLOTS))
    # What a trigram of a language's own texts is worth.
    share = counts / np.maximum(1, counts.sum(axis=0))
    mean = (share * table).sum(axis=0)
    deviation = np.sqrt((share * (table - mean) ** 2).sum(axis=0))
    return TextModel(languages, table, mean, deviation)


def _tempered(model: TextModel):
    """Per row: log likelihoods of a text that weighs ``WEIGHT`` trigrams at most, then
    by how much its mean is above the bound of the language it suits best, then its size."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        batch = pa.record_batch({"text": texts})
        for part in X.slices(iter([batch]), size=SLICE):
            sums, n = model.score(X.column(part, "text"))
            mean = sums / np.maximum(n, 1)[:, None]
            weight = np.minimum(n, WEIGHT)[:, None]
            bound = model.mean - FAR * model.deviation / np.sqrt(np.maximum(weight, 1))
            rows = np.column_stack((mean * weight, (mean - bound).max(axis=1), n))
            out.append(rows)
        flat = np.concatenate(out) if out else np.zeros((0, len(model.languages) + 2))
        return pa.array(list(flat), pa.list_(pa.float64()))

    return F.arrow_udf(run, T.ArrayType(T.DoubleType()))


def identify(
    rows: DataFrame, text: Column, declared: Column | None = None, host: Column | None = None,
    model: TextModel | None = None, id_column: str = "doc_id",
) -> DataFrame:
    """Rows (row, language, probability, rejected): ``row`` holds the columns of ``rows``, one row for each.

    ``declared`` is the declared language of a row and ``host`` where it is from, as a name or a full host name; its
    suffix is what follows the last dot. Evidence that a row lacks (null) does not count. Without ``model``, one is fitted
    to the rows that declare a language. A row is rejected if its text has no letters, or is in none of the known
    languages: its mean likelihood per trigram is far below that of each language's sample, or no language reaches one
    half.

    A null, empty or letterless text is rejected, with the language that its other evidence suggests. Rows that repeat
    an id are judged one by one. An empty table gives an empty result. Columns of any name are carried along.
    """
    X.short_batches(rows.sparkSession)
    none = F.lit(None).cast("string")
    declared = primary(declared.cast("string")) if declared is not None else none
    host = host.cast("string") if host is not None else none
    text = F.coalesce(text.cast("string"), F.lit(""))
    base = rows.select(F.struct("*").alias("row"), text.alias("text"), declared.alias("declared"), host.alias("host"))
    if model is None:
        labelled = rows.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text.alias("text"), declared.alias("lang"))
        model = fit_text_model(labelled)
    names, k = model.languages, len(model.languages)
    scored = base.withColumn("found", _tempered(model)("text"))
    scored = scored.withColumn("suffix", F.when(F.instr("host", ".") > 0, F.substring_index("host", ".", -1)))
    # Each row counts under the language that its text suggests, if it has one.
    likely = F.slice("found", 1, k)
    best = F.when(F.element_at("found", -1) > 0, F.array_position(likely, F.array_max(likely)).cast("int"))
    narrow = stored(scored.select(best.alias("best"), "declared", "host", "suffix").where("best is not null"), "evidence")

    def counts(*keys: str) -> DataFrame:
        each = [F.sum((F.col("best") == i + 1).cast("double")) for i in range(k)]
        return stored(narrow.groupBy(*keys).agg(F.array(*each).alias("n")), "counts")

    everywhere = counts().first()
    total = np.asarray(everywhere["n"] if everywhere and everywhere["n"] and everywhere["n"][0] is not None else [0.0] * k)
    by_host, by_suffix, by_declared = counts("host"), counts("suffix"), counts("declared")

    out = scored.withColumn("best", best)
    for name, table in (("host", by_host), ("suffix", by_suffix), ("declared", by_declared)):
        table = table.where(F.col(name).isNotNull()).select(F.col(name).alias(f"{name}_key"), F.col("n").alias(f"n_{name}"))
        out = out.join(table, out[name] == table[f"{name}_key"], "left").drop(f"{name}_key")
    own = F.array(*(F.coalesce((F.col("best") == i + 1).cast("double"), F.lit(0.0)) for i in range(k)))
    zero = F.array(*[F.lit(0.0)] * k)

    def without_own(counted: Column) -> Column:
        return F.coalesce(F.zip_with(counted, own, lambda n, o: n - o), zero)

    def drawn(counted: Column, prior: Column, strength: float) -> Column:
        size = F.aggregate(counted, F.lit(0.0), lambda a, x: a + x) + strength
        return F.zip_with(counted, prior, lambda n, p: (n + strength * p) / size)

    even = F.array(*[F.lit(1.0 / k)] * k)
    table_counts = F.zip_with(F.array(*map(F.lit, map(float, total))), own, lambda n, o: F.greatest(n - o, F.lit(0.0)))
    out = out.withColumn("p_table", drawn(table_counts, even, TO_EVEN))
    out = out.withColumn("p_suffix", drawn(without_own(F.col("n_suffix")), F.col("p_table"), TO_TABLE))
    out = out.withColumn("p_host", drawn(without_own(F.col("n_host")), F.col("p_suffix"), TO_SUFFIX))
    # P(declared | language): of the rows of a language, the share that declares this one.
    n_declared = F.when(F.col("declared").isNotNull(), without_own(F.col("n_declared")))
    says = F.zip_with(n_declared, table_counts, lambda d, n: F.log((d + 0.5) / (n + 0.5 * (k + 1))))
    out = out.withColumn("log_declared", F.coalesce(says, zero))
    odds = F.zip_with(F.zip_with(F.slice("found", 1, k), F.col("p_host"), lambda x, p: x + F.log(p)), F.col("log_declared"), lambda x, d: x + d)
    out = out.withColumn("odds", odds).withColumn("most", F.array_max("odds"))
    share = 1 / F.aggregate(F.transform("odds", lambda x: F.exp(x - F.col("most"))), F.lit(0.0), lambda a, x: a + x)
    language = F.element_at(F.array(*map(F.lit, names)), F.array_position("odds", F.col("most")).cast("int"))
    size, above = F.element_at("found", -1), F.element_at("found", -2)
    rejected = (size == 0) | (above < 0) | (share < 0.5)
    return out.select("row", language.alias("language"), share.alias("probability"), rejected.alias("rejected"))
