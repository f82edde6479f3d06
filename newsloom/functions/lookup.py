"""Constant dictionaries as column lookups, for sizes that are checked before the plan is built."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# A dictionary travels inside the plan, so its size is bounded here; larger ones belong in a join.
MAX_ENTRIES = 200_000
_PER_BUCKET = 8


def lookup(entries: Mapping[str, object], value_type: str) -> Callable[[Column], Column]:
    """A function that maps a text column to its dictionary value, or null.

    Spark searches a map literal from front to back, so the entries are spread over small maps
    that are picked by checksum. The literal is folded once; nothing is joined or shuffled.
    """
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"{len(entries)} entries; use operators.dictionary.with_dictionary")
    size = max(1, len(entries) // _PER_BUCKET)
    buckets: list[dict] = [{} for _ in range(size)]
    for key, value in entries.items():
        buckets[zlib.crc32(key.encode()) % size][key] = value
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{value_type}>>")

    def value_of(word: Column) -> Column:
        bucket = F.get(table, (F.crc32(word) % size).cast("int"))
        return F.try_element_at(bucket, word)

    return value_of


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
