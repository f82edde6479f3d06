"""Mixing sources to target weights by Pareto order sampling.

A source that is to give r words for each of its own takes every document floor(r) times for certain. What is left
is a sample of its documents with inclusion odds f / (1 - f), f = r - floor(r): documents are ranked by their random
odds u / (1 - u) over those odds, and the smallest are taken up to the words the source still lacks.

The ranks are cut without sorting a source: sizes are summed by source and rank interval, the interval in which the
words run out is found in these sums, and only its documents are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stored

WEIGHTS = (5, 2, 1)
CAP = 3
# Rank intervals per source. Only documents of one interval are sorted, so this bounds a sort's share of a source.
INTERVALS = 1 << 14
# Random numbers are fractions of this.
_STEPS = 1 << 52


def word_count(text: str) -> Column:
    """The number of runs ``[^\\x20\\x09-\\x0D]+`` in a text; null and blank texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Rows (source, source_size, target) for rows (source, source_size), one per source.

    Sources in code point order, null last, weigh ``weights``, repeating, and share the sum of all sizes. A target
    stops at ``cap`` times its source's size, and the excess is shared by weight among the rest, until none is above.

    All shares end up as min(cap * size, level * weight) for one level, so sources are put in the order in which they
    reach their cap, and the level follows from running sums. Empty sources get nothing. The table has a row per
    source and is small beside the documents.
    """
    one = Window.partitionBy(F.lit(0))
    position = one.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(position) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("weight", w).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    t = t.withColumn("turn", F.col("most") / F.col("weight"))
    by_turn = one.orderBy("turn", F.col("source").isNull(), "source")
    before = by_turn.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("total", F.sum("source_size").over(one).cast("double"))
    t = t.withColumn("capped", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
    t = t.withColumn("open", F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # The level if this source and all later ones stay below their cap: right for the first that does.
    t = t.withColumn("try", (F.col("total") - F.col("capped")) / F.col("open"))
    level = F.min(F.when(F.col("try") <= F.col("turn"), F.struct("turn", "try"))).over(one)["try"]
    target = F.least(F.col("most"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return t.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", carry: Sequence[str] = (),
    weights: Sequence[float] = WEIGHTS, cap: float = CAP, seed: str = "mix",
) -> DataFrame:
    """Rows (doc_id, size, source_size, target, copies, taken), one for each row of ``docs``, with its columns ``carry``.

    ``size`` is the number of words; a null, empty or blank text has none. ``copies`` says how often the mix takes the
    document, and ``taken`` is copies * size. No document is taken more than ``cap`` times, rounded up. A source's taken
    words miss its target by half a document at most. A document of no words ranks like any other.

    The random number of a row comes from the seed and its id alone, so reruns agree. Rows with the same id (or none)
    share it and rank by size; rows equal in both are taken or left together. Null sources are one source of their own.
    An empty table gives an empty result. Other columns are not read.
    """
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13)
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        word_count(f"`{text}`").alias("size"),
        F.struct(*(F.col(f"`{c}`") for c in carry) if carry else [F.lit(True)]).alias("carry"),
    )
    rows = rows.withColumn("draw", F.conv(digits, 16, 10).cast("long"))
    rows = rows.withColumn("interval", F.floor(F.col("draw") / F.lit(_STEPS // INTERVALS)).cast("int"))
    sized = stored(rows.drop("carry"), "sizes")
    sums = stored(sized.groupBy("source", "interval").agg(F.sum("size").alias("words")), "sums")
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    ratio = F.col("target") / F.expr("nullif(source_size, 0)")
    targets = targets.withColumn("certain", F.coalesce(F.floor(ratio), F.lit(0)).cast("long"))
    targets = targets.withColumn("lacking", F.greatest(F.lit(0.0), F.col("target") - F.col("certain") * F.col("source_size")))
    targets = targets.withColumn("chance", F.coalesce(ratio - F.col("certain"), F.lit(0.0)))

    # The interval of each source in which its words run out. Odds of inclusion are equal within a source, so
    # intervals of the random numbers are intervals of the ranks.
    so_far = Window.partitionBy("source").orderBy("interval").rowsBetween(Window.unboundedPreceding, -1)
    running = sums.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    fields = ["source", "source_size", "target", "certain", "lacking", "chance"]
    cut = running.alias("s").join(targets.alias("t"), F.expr("s.source <=> t.source")).groupBy(*(F.col(f"t.{f}") for f in fields))
    cut = cut.agg(F.max(F.when(F.col("before") < F.col("lacking"), F.struct("interval", "before"))).alias("cut"))
    cut = cut.select(F.col("source").alias("of"), *fields[1:], F.col("cut.interval").alias("last"), F.col("cut.before").alias("before"))
    cut = stored(cut, "cut")

    # The documents of that interval are ranked; the last one taken is the bound.
    u = (F.col("draw") + 0.5) / F.lit(float(_STEPS))
    rank = (u / (1 - u)) / (F.col("chance") / (1 - F.col("chance")))
    spot = F.struct("draw", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "size")
    edge = sized.join(cut, F.col("source").eqNullSafe(F.col("of"))).where("interval = last")
    order = Window.partitionBy("of").orderBy(rank, spot).rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    fits = (F.col("ahead") + F.col("size") / 2 <= F.col("lacking")) & (F.col("ahead") < F.col("lacking"))
    bound = edge.groupBy("of").agg(F.max(F.when(fits, spot)).alias("bound"))
    cut = cut.alias("c").join(bound.alias("b"), F.expr("c.of <=> b.of"), "left").select("c.*", "b.bound")
    cut = stored(cut, "cut")  # a row per source, so Spark knows whether to broadcast it

    out = (rows if carry else sized.withColumn("carry", F.struct(F.lit(True)))).join(cut, F.col("source").eqNullSafe(F.col("of")))
    more = (F.col("interval") < F.col("last")) | ((F.col("interval") == F.col("last")) & (spot <= F.col("bound")))
    copies = F.col("certain") + F.coalesce(more, F.lit(False)).cast("long")
    kept = [F.col(f"carry.`{c}`") for c in carry]
    return out.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *kept)


# The same rows in DuckDB's SQL, with the order of all documents of a source.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 13))::BIGINT AS draw
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 3.0::DOUBLE * source_size AS most,
         [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)] AS weight,
         (sum(source_size) OVER ())::DOUBLE AS total
  FROM sources),
levels AS (
  SELECT *, most / weight AS turn,
         (total - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY most / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least(most, coalesce((SELECT arg_min(level, turn) FROM levels WHERE level <= turn), 'inf'::DOUBLE) * weight) AS target
  FROM levels),
parts AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS certain FROM targets),
ranked AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.certain,
         greatest(0, p.target - p.certain * p.source_size) AS lacking,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       certain + (ahead + size / 2.0 <= lacking AND ahead < lacking)::BIGINT AS copies,
       (certain + (ahead + size / 2.0 <= lacking AND ahead < lacking)::BIGINT) * size AS taken
FROM ranked
"""
