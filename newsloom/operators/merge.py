"""Unions, keep-first dedup and the merges of rows that share a key.

"First" is always decided by an ordinal column (``_seq`` unless named otherwise), never by the
order in which rows happen to arrive. All per-key results are aggregates with a map-side part, so
a key that holds a large share of the rows is reduced before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.dictionaries import SOURCE_RANK, UNRANKED
from newsloom.functions.lookup import lookup
from newsloom.functions.parse import with_lists, with_terms
from newsloom.operators.validate import require_columns

SEQ = "_seq"

# Texts of one key are joined in runs of at most this many ordinals before the runs are joined.
RUN_LENGTH = 1 << 14


def union_sources(
    tables: Sequence[DataFrame], common_columns: Sequence[str] | None = None
) -> DataFrame:
    """Bag union. Without ``common_columns`` all tables must have the columns of the first."""
    if not tables:
        raise ValueError("No tables to merge")
    wanted = list(common_columns or tables[0].columns)
    for number, table in enumerate(tables[1:], start=2):
        if common_columns is None and set(table.columns) != set(wanted):
            raise KeyError(f"Column mismatch at table #{number}")
        if not set(wanted) <= set(table.columns):
            missing = sorted(set(wanted) - set(table.columns))
            raise KeyError(f"Missing columns in table #{number}: {missing}")
    return reduce(DataFrame.unionByName, [require_columns(t, wanted).select(wanted) for t in tables])


def source_rank(data_source: Column, ranks: Mapping[str, int] = SOURCE_RANK) -> Column:
    """Rank of a source; unknown sources come last."""
    return F.coalesce(lookup(ranks, "int")(data_source), F.lit(UNRANKED))


def keep_first(df: DataFrame, keys: Sequence[str], seq: str = SEQ) -> DataFrame:
    """The first row per key. Rows without a key count as one group.

    Spark turns the filter on the row number into a limit per key on the map side, so of a frequent
    key only one row per map task is shuffled.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(seq))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def term_union(
    df: DataFrame,
    key: str = "url",
    terms: str = "search_terms",
    seq: str = SEQ,
    null_as_empty: bool = False,
) -> DataFrame:
    """The first row per key as a whole, with the sorted distinct terms of all its rows.

    Rows without a key are dropped. Of term lists, the distinct ones of a key are shuffled, and of rows one per map
    task and key.
    """
    require_columns(df, [key, terms, seq])
    rows = with_terms(df.where(F.col(key).isNotNull()), terms, null_as_empty)
    rest = [c for c in df.columns if c not in (key, terms)]
    lists = F.collect_set(F.coalesce(terms, F.array().cast("array<string>")))
    merged = rows.groupBy(key).agg(
        F.min_by(F.struct(*rest), F.col(seq)).alias("row"),
        F.array_sort(F.filter(F.array_distinct(F.flatten(lists)), lambda t: t.isNotNull())).alias(terms),
    )
    columns = [F.col(c) if c in (key, terms) else F.col(f"row.{c}").alias(c) for c in df.columns]
    return merged.select(*columns)


def _in_order(items: Column, separator: str = " ") -> Column:
    """Texts of structs whose first fields are their place, joined in that order."""
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["text"]), separator)


def _run(ordinal: str) -> Column:
    return F.floor(F.col(ordinal) / RUN_LENGTH)


def joined_text(
    df: DataFrame, key: str, order: Sequence[str], text: str, separator: str = " ", count: str | None = None
) -> DataFrame:
    """Texts per key in ``order`` (whose first column is a whole number), joined into one; ``count`` names their number.

    Runs of consecutive ordinals are sorted and joined first, each by whichever task owns the run,
    so the texts of a frequent key are spread over tasks and only finished runs meet at the end.
    """
    place = F.struct(*order, F.col(text).alias("text"))
    return (
        df.groupBy(key, _run(order[0]).alias("_run"))
        .agg(_in_order(F.collect_list(place), separator).alias("_part"), F.count(F.lit(1)).alias("_n"))
        .groupBy(key)
        .agg(
            _in_order(F.collect_list(F.struct("_run", F.col("_part").alias("text"))), separator)
            .alias(text),
            *([F.sum("_n").alias(count)] if count else []),
        )
    )


def best_row_merge(
    df: DataFrame, key: str = "url", seq: str = SEQ, ranks: Mapping[str, int] = SOURCE_RANK
) -> DataFrame:
    """One row per key: each column's first value that is not null, best ranked source first.

    ``description`` joins all descriptions in input order, empty if there are none, and
    ``was_merged`` tells whether there was more than one. Rows without a key are dropped. One scan, one shuffle and no
    join: everything but the descriptions is reduced before the shuffle, and those of a key end in one cell anyway.
    """
    require_columns(df, ["data_source", "description", key, "datetime", seq])
    plain = [c for c in df.columns if c not in (key, "description", seq)]
    rows = df.where(F.col(key).isNotNull()).withColumn(
        "_order", F.struct(source_rank(F.col("data_source"), ranks), F.col(seq))
    )

    def first_of(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_order")))

    described = F.when(
        F.col("description").isNotNull(), F.struct(seq, F.col("description").alias("text"))
    )
    merged = rows.groupBy(key).agg(
        *[first_of(c).alias(c) for c in plain],
        F.min(seq).alias(seq),
        (F.count("description") > 1).alias("was_merged"),
        _in_order(F.collect_list(described)).alias("description"),
    )
    return merged.select(*df.columns, "was_merged")


def upsert(
    batch: DataFrame,
    main: DataFrame | None,
    key: str = "url",
    terms: str = "search_terms",
    main_is_unique: bool = False,
) -> DataFrame:
    """Batch rows over main rows: the batch row wins, terms are united. No main means an empty one.

    Main is read and shuffled once. With ``main_is_unique`` (main holds each key once, as every earlier result does) it
    meets the batch in one join and is not aggregated.
    """
    if main is None:
        return term_union(batch, key, terms)
    columns = [c for c in batch.columns if c != SEQ]
    if set(columns) != set(c for c in main.columns if c != SEQ):
        raise KeyError("Column mismatch between batch and main")
    has_seq = SEQ in batch.columns
    kind = batch.schema[SEQ].dataType if has_seq else "long"

    def ranked(df: DataFrame, side: int) -> DataFrame:
        same = SEQ in df.columns and df.schema[SEQ].dataType == kind
        order = F.struct(F.lit(side).alias("side"), (F.col(SEQ) if same else F.lit(None).cast(kind)).alias("seq"))
        return with_terms(df, terms).select(*columns, order.alias(SEQ))

    if not main_is_unique:
        both = ranked(batch, 0).unionByName(ranked(main, 1))
        return term_union(both, key, terms).drop(SEQ)

    new = term_union(ranked(batch, 0), key, terms).drop(SEQ).select(F.col(key).alias("_key"), F.struct(*columns).alias("new"))
    old = with_terms(main, terms).where(F.col(key).isNotNull()).select(key, F.struct(*columns).alias("old"))
    both = old.join(new, F.col(key) == F.col("_key"), "full_outer")
    fresh = F.col("new").isNotNull()
    none = F.array().cast("array<string>")
    united = F.array_sort(F.array_distinct(F.concat(F.coalesce(f"new.{terms}", none), F.coalesce(f"old.{terms}", none))))
    return both.select(
        *[
            (F.when(fresh & F.col("old").isNotNull(), united).when(fresh, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
             if c == terms else F.when(fresh, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))).alias(c)
            for c in columns
        ]
    )


def append_distinct(new: DataFrame, main: DataFrame | None) -> DataFrame:
    """All different rows of both tables, each read and shuffled once."""
    return new.distinct() if main is None else new.unionByName(main.select(new.columns)).distinct()


def sorted_layer(df: DataFrame, *order: str) -> DataFrame:
    """Rows sorted over all partitions. Further order columns split runs of equal times."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def last_seen(df: DataFrame, ticker: str | None = None) -> DataFrame:
    """Latest ``datetime`` of one ticker (null if never seen), or of every ticker."""
    df = with_lists(df, "ticker_names")  # exports hold lists as text
    if ticker is not None:
        seen = df.where(F.array_contains("ticker_names", ticker.upper()))
        return seen.agg(F.max("datetime").alias("last_seen"))
    return (
        df.select(F.explode("ticker_names").alias("ticker"), "datetime")
        .groupBy("ticker")
        .agg(F.max("datetime").alias("last_seen"))
    )
