"""Runs of a source over whatever has landed since the last run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from newsloom.dictionaries import SOURCE_A
from newsloom.functions.text import Lexicon
from newsloom.plans.runs import run_source
from newsloom.sources.landing import (
    ingest_feed, ingest_pages, judged, stream_landing, usable_envelopes,
)


def ingest_new(
    spark: SparkSession,
    landing: str,
    source: str,
    root: str,
    lexicon: Lexicon,
    terms: Sequence[str] | None = None,
    **options,
) -> StreamingQuery:
    """Put all newly landed envelopes of a source through a run, then stop.

    The files that were done are remembered in a checkpoint under ``root``. A batch that is repeated
    after a failure gives the same main tables, since an upsert done twice equals one done once.
    """
    key, with_status = ("feed", False) if source == SOURCE_A else ("results", True)
    ingest = ingest_feed if source == SOURCE_A else ingest_pages

    def one_batch(envelopes: DataFrame, _: int) -> None:
        good = usable_envelopes(judged(envelopes, key, with_status), terms)
        if not good.isEmpty():
            run_source(ingest(good, terms), source, root, lexicon, **options)

    return (
        stream_landing(spark, landing)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", f"{root}/progress/{source}")
        .trigger(availableNow=True)
        .start()
    )
