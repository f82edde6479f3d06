"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with its transpose.

1. One scan counts n-grams that occur more than once within some thousand texts, in a table of 2^20 slots (its size never
   grows), and takes a 128-bit fingerprint of each text's set and a bitmap of about as many bits as it has n-grams: each
   n-gram flips one. Texts with equal sets are one class from then on, and a block of columns has one row of each.
2. Columns of the incidence matrix are ordered from rare to frequent slots. Two sets of at least the wanted
   similarity share a column among the first ``n - ceil(t * n) + 1`` of either, so only that part of each row is
   kept, and frequent words, lines and passages drop out of nearly all rows.
3. Columns are dealt to blocks. A block multiplies its columns: it accumulates the overlap of each pair that meets in
   it and discards pairs that their sizes and the place of the column in either row rule out. A column of more than
   ``WIDE`` rows is only paired with one of its rows per size range.
4. Bitmaps of a pair differ in at most as many bits as the sets differ in n-grams, which rules out nearly all pairs that
   share some columns only. Texts are moved for the others, and only those that are part of one.
5. Of each text's pairs, that with the smallest id and that with the largest are compared by their whole sets first, and
   those that pass are links. Only pairs and rows of wide columns in different components may still hide a link: those
   pairs, and no others, are compared too. A group of thousands of near copies is one component by then and gives no pairs.

The order needs counts only to be fast: any order of columns gives the same links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import texts as X
from newsloom.llm.components import components
from newsloom.session import stored

SLOTS = 1 << 20
PIECE = 1 << 16
# Columns with more rows than this are not multiplied out at once.
WIDE = 24
# Entries that a task holds before it passes them on.
HELD = 1 << 18
# N-grams among which repeated ones are counted.
COUNTED = 1 << 20
# Binary logarithm of the most bits that tell which texts are part of a pair (16 MiB).
MARKS = 27

_ENTRY = np.dtype([("key", "<u8"), ("doc", "<i8"), ("n", "<i4"), ("at", "<i4")])
_PAIR = np.dtype([("a", "<i8"), ("b", "<i8")])


def _flips(s: np.ndarray) -> bytes:
    """A bitmap of a set: each member flips the bit of its hash. It has a power of two of bits, at least one per member."""
    bits = max(64, 1 << (len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def _folded(maps: np.ndarray, words: int) -> np.ndarray:
    """The bitmaps that the sets of ``maps`` (a row of 64-bit words each) have with fewer bits."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def _few_flips(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` members may be similar by their bitmaps, row by row.

    A bit that differs takes a member of one set only. Of similar sets, these are at most (100 - percent) / (100 + percent)
    of n + m.
    """
    words = min(a.shape[1], b.shape[1])
    differ = np.bitwise_count(_folded(a, words) ^ _folded(b, words)).sum(axis=1, dtype=np.int64)
    return (100 + percent) * differ <= (100 - percent) * (n + m)


def _by_width(maps: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of bitmaps of one width, and these as 64-bit words."""
    widths = pc.binary_length(maps).to_numpy(zero_copy_only=False)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        yield rows, np.frombuffer(b"".join(maps.take(pa.array(rows)).to_pylist()), np.uint64).reshape(len(rows), -1)


class _Counts:
    """Counts by slot of n-grams that come twice or more among ``COUNTED``. Single ones, nearly all, would fill all slots alike."""

    def __init__(self) -> None:
        self.total, self.held, self.n = np.zeros(SLOTS, np.int64), [], 0

    def add(self, sets: list[np.ndarray]) -> None:
        self.held += sets
        self.n += sum(map(len, sets))
        if self.n >= COUNTED:
            self.close()

    def close(self) -> None:
        found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.held]), return_counts=True)
        slots = (found[n > 1] & np.uint64(SLOTS - 1)).astype(np.int64)
        self.total += np.bincount(slots, n[n > 1], SLOTS).astype(np.int64)
        self.held, self.n = [], 0


def _survey(k: int):
    """Size, fingerprint and bitmap of each text's set, and this task's counts by slot, in compressed pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = X.Words(), _Counts()
        for batch in X.slices(batches):
            sets = X.shingle_sets(words, X.column(batch, "text"), k)
            counts.add(sets)
            one = [int(s.sum(dtype=np.uint64)) for s in sets]
            two = [int(np.bitwise_xor.reduce(X.mix(s))) if len(s) else 0 for s in sets]
            yield pa.record_batch(
                {
                    "doc_id": X.column(batch, "doc_id"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "one": pa.array(np.asarray(one, np.uint64).view(np.int64)),
                    "two": pa.array(np.asarray(two, np.uint64).view(np.int64)),
                    "flips": pa.array([_flips(s) if len(s) else None for s in sets], pa.binary()),
                    "piece": pa.nulls(len(sets), pa.int32()),
                    "counts": pa.nulls(len(sets), pa.binary()),
                }
            )
        counts.close()
        for piece in range(SLOTS // PIECE):
            part = counts.total[piece * PIECE : (piece + 1) * PIECE]
            if part.any():
                yield pa.record_batch(
                    {
                        "doc_id": pa.nulls(1, pa.int64()), "n": pa.nulls(1, pa.int64()), "one": pa.nulls(1, pa.int64()), "two": pa.nulls(1, pa.int64()), "flips": pa.nulls(1, pa.binary()),
                        "piece": pa.array([piece], pa.int32()), "counts": pa.array([pa.compress(part.astype("<u4").tobytes(), "zstd", asbytes=True)], pa.binary()),
                    }
                )

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of pieces of slot counts; at most all slots are held."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, part in zip(X.column(batch, "piece").to_pylist(), X.column(batch, "counts"), strict=True):
            part = np.frombuffer(pa.decompress(part.as_buffer(), 4 * PIECE, "zstd"), "<u4").astype(np.int64)
            sums[piece] = sums[piece] + part if piece in sums else part
    for piece, total in sums.items():
        yield pa.record_batch({"piece": pa.array([piece], pa.int32()), "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def column_classes(survey: DataFrame) -> np.ndarray:
    """The binary logarithm of the count of each slot: a table of fixed size (1 MiB)."""
    sums = survey.where("piece is not null").select("piece", "counts").repartition("piece").mapInArrow(_summed, "piece int, counts binary")
    total = np.zeros(SLOTS, np.int64)
    for row in sums.toLocalIterator():
        total[row.piece * PIECE : (row.piece + 1) * PIECE] += np.frombuffer(row.counts, "<i8")
    return np.frexp(total.astype(np.float64))[1].astype(np.uint8)


def _entries(k: int, percent: int, blocks: int, classes):
    """The kept columns of each text, packed by block of columns. A text's row is the second half of its set's fingerprint.

    Texts of equal sets that meet in a task are entered once; others become one row in a block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = X.Words(), classes.value
        held, count, seen = [], 0, set()
        for batch in X.slices(batches):
            sets = X.shingle_sets(words, X.column(batch, "text"), k)
            known = X.column(batch, "doc_id").is_valid().to_pylist()
            for i, s in enumerate(sets):
                if not len(s) or not known[i]:
                    continue
                mark = (len(s), int(s.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(X.mix(s))))
                if mark in seen:
                    continue
                seen.add(mark)
                keep = len(s) - -(-percent * len(s) // 100) + 1
                keys = (table[(s & np.uint64(SLOTS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(58)) | (s >> np.uint64(6))
                part = np.zeros(keep, _ENTRY)
                part["key"], part["at"] = np.sort(np.partition(keys, keep - 1)[:keep]), np.arange(keep)
                part["doc"], part["n"] = np.uint64(mark[2]).view(np.int64), len(s)
                held.append(part)
                count += keep
            if count >= HELD:
                out = np.concatenate(held)
                yield X.packed((X.mix(out["key"]) % np.uint64(blocks)).astype(np.int32), out)
                held, count, seen = [], 0, set()
        if held:
            out = np.concatenate(held)
            yield X.packed((X.mix(out["key"]) % np.uint64(blocks)).astype(np.int32), out)

    return run


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values in a sorted array."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(keys)))


def _may_link(n: np.ndarray, i: np.ndarray, m: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` columns may be similar if their first common one is their column ``i`` and ``j``.

    Then at most min(n - i, m - j) are common, and the similarity takes percent / (100 + percent) of n + m. A similar
    pair passes in its first common column, so it is lost nowhere, whatever it does in others.
    """
    return (100 + percent) * np.minimum(n - i, m - j) >= percent * (n + m)


def _product(percent: int, buckets: int):
    """Multiply the columns of a block: distinct pairs, packed, and the rows of its wide columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = X.unpacked(batches, _ENTRY)
        if not len(e):
            return
        e = e[np.lexsort((e["doc"], e["n"], e["key"]))]
        e = e[np.concatenate(([True], (e["key"][1:] != e["key"][:-1]) | (e["doc"][1:] != e["doc"][:-1])))]
        starts, lengths = _runs(e["key"])
        n, at, doc = e["n"].astype(np.int64), e["at"].astype(np.int64), e["doc"]
        left, right = [], []
        for length in np.unique(lengths[(lengths > 1) & (lengths <= WIDE)]):
            rows = starts[lengths == length]
            i, j = np.triu_indices(length, 1)
            for part in np.array_split(rows, -(-len(rows) * len(i) // HELD)):
                a, b = (part[:, None] + i).ravel(), (part[:, None] + j).ravel()
                fits = _may_link(n[a], at[a], n[b], at[b], percent)
                left.append(doc[a[fits]])
                right.append(doc[b[fits]])
        wide = np.flatnonzero(lengths > WIDE)
        for x in wide:
            s, t = starts[x], starts[x] + lengths[x]
            while s < t:
                stop = s + np.searchsorted(n[s:t], n[s] * 100 // percent, "right")
                lead = s + np.argmin(at[s:stop])  # few of its columns are rarer, so it is most like the others
                fits = s + np.flatnonzero(_may_link(n[s:stop], at[s:stop], n[lead], at[lead], percent))
                left.append(np.full(len(fits), doc[lead]))
                right.append(doc[fits])
                s = stop
        if left:
            pairs = np.zeros(sum(map(len, left)), _PAIR)
            a, b = np.concatenate(left), np.concatenate(right)
            pairs["a"], pairs["b"] = np.minimum(a, b), np.maximum(a, b)
            pairs = np.unique(pairs[pairs["a"] < pairs["b"]])
            if len(pairs):
                found = X.packed((X.mix(pairs["a"].view(np.uint64) * np.uint64(3) + pairs["b"].view(np.uint64)) % np.uint64(buckets)).astype(np.int32), pairs)
                yield found.append_column("wide", pa.array(np.zeros(found.num_rows, bool)))
        if len(wide):
            rows = np.concatenate([np.arange(starts[x], starts[x] + lengths[x]) for x in wide])
            found = X.packed((np.arange(len(rows)) // HELD).astype(np.int32), e[rows])
            yield found.append_column("wide", pa.array(np.ones(found.num_rows, bool)))

    return run


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = np.unique(X.unpacked(batches, _PAIR))
    yield pa.record_batch({"a": pa.array(pairs["a"]), "b": pa.array(pairs["b"])})


def _unpack_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        e = X.unpacked(iter([batch]), _ENTRY)
        yield pa.record_batch({"key": pa.array(e["key"].view(np.int64)), "doc": pa.array(e["doc"]), "n": pa.array(e["n"].astype(np.int64)), "at": pa.array(e["at"].astype(np.int64))})


def _by_flips(percent: int):
    """Keep the pairs whose bitmaps do not rule them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            n, m = X.longs(batch, "n_a"), X.longs(batch, "n_b")
            for rows, a in _by_width(X.column(batch, "flips_a")):
                for some, b in _by_width(X.column(batch, "flips_b").take(pa.array(rows))):
                    good[rows[some]] = _few_flips(a[some], n[rows[some]], b, m[rows[some]], percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _across(percent: int):
    """Of rows in order of their column, pairs of a column in different components that neither places nor bitmaps rule out.

    A task holds the rows of one column, and compares some of them at a time with the others. Pairs are distinct within a
    batch of them.
    """

    def pairs_of(column: pa.Table) -> Iterator[np.ndarray]:
        node, n, rest, of = (column[c].to_numpy() for c in ("node", "n", "rest", "component"))
        widths = list(_by_width(column["flips"].combine_chunks()))
        for rows, a in widths:
            step = max(1, HELD // len(node))
            for top in range(0, len(rows), step):
                mine = rows[top : top + step]
                for others, b in widths:
                    # Each pair once: the one of smaller node comes first.
                    fits = (node[mine][:, None] < node[others]) & (of[mine][:, None] != of[others])
                    fits &= (100 + percent) * np.minimum(rest[mine][:, None], rest[others]) >= percent * (n[mine][:, None] + n[others])
                    i, j = np.nonzero(fits)
                    for cut in range(0, len(i), 4096):
                        x, y = i[cut : cut + 4096], j[cut : cut + 4096]
                        good = _few_flips(a[top + x], n[mine[x]], b[y], n[others[y]], percent)
                        found = np.zeros(int(good.sum()), _PAIR)
                        found["a"], found["b"] = node[mine[x[good]]], node[others[y[good]]]
                        yield found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns() -> Iterator[pa.Table]:
            held = []
            for batch in batches:
                starts, lengths = _runs(X.longs(batch, "key"))
                for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
                    if held and held[0].column(0)[0] != batch.column(0)[start]:
                        yield pa.Table.from_batches(held)
                        held = []
                    held.append(batch.slice(start, length))
            if held:
                yield pa.Table.from_batches(held)

        held, count = [], 0
        for column in columns():
            for found in pairs_of(column):
                held.append(found)
                count += len(found)
                if count >= HELD:
                    pairs = np.unique(np.concatenate(held))
                    yield pa.record_batch({"a": pa.array(pairs["a"]), "b": pa.array(pairs["b"])})
                    held, count = [], 0
        if count:
            pairs = np.unique(np.concatenate(held))
            yield pa.record_batch({"a": pa.array(pairs["a"]), "b": pa.array(pairs["b"])})

    return run


def by_marks(df: DataFrame, ids: DataFrame, column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Rows whose id is one of ``ids``, and a few others; and all others. Nothing is shuffled, and null ids are left out.

    ``ids`` has one column, also called ``column``, and no nulls. A bitmap of bounded size, 16 bits per id if that fits,
    tells rows apart.
    """
    spark, whole = df.sparkSession, df.columns
    ids = ids.select(F.col(column).cast("long").alias("id")).distinct()
    bits = 1 << min(MARKS, max(15, (16 * ids.count()).bit_length()))

    def slot(of: str):
        return F.xxhash64(F.col(of).cast("long")).bitwiseAND(F.lit(bits - 1))

    # Bitmaps of 4 KiB, at most 4,096 of them, come to the driver.
    pieces = ids.select(slot("id").alias("slot")).groupBy(F.shiftright("slot", 15).alias("piece"))
    marks = np.zeros(max(bits // 8, 4096), np.uint8)
    for row in pieces.agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(0x7FFF))).alias("marks")).collect():
        marks[row.piece << 12 : (row.piece + 1) << 12] = np.frombuffer(row.marks, np.uint8)
    shared = spark.sparkContext.broadcast(marks)

    def of_mark(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = X.longs(batch, "_slot")
                marked = (shared.value[at >> 3] >> (at & 7) & 1).astype(bool)
                yield batch.select(whole).filter(pa.array(marked == wanted))

        return run

    known = df.where(F.col(column).isNotNull()).withColumn("_slot", slot(column))
    return known.mapInArrow(of_mark(True), df.schema), known.mapInArrow(of_mark(False), df.schema)


def _compare(k: int, percent: int):
    """Keep the pairs whose whole sets are similar. Rows of an id may have different texts; each is compared as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last, kept = X.Words(), None, None
        for batch in X.slices(batches, "text_b"):
            a, b = X.longs(batch, "a"), X.longs(batch, "b")
            ours = X.shingle_sets(words, X.column(batch, "text_b"), k)
            # Runs of one text_a have one set; the first may go on from the batch before.
            texts = X.column(batch, "text_a")
            changed = pc.not_equal(texts.slice(1), texts.slice(0, len(texts) - 1)).to_numpy(zero_copy_only=False)
            fresh = np.concatenate(([last is None or not texts[0].equals(last)], changed))
            theirs = [kept, *X.shingle_sets(words, texts.take(pa.array(np.flatnonzero(fresh))), k)]
            good = []
            for mine, run_of in zip(ours, np.cumsum(fresh).tolist(), strict=True):
                other = theirs[run_of]
                both = len(mine) + len(other) - len(np.unique(np.concatenate((mine, other))))
                good.append(both > 0 and 100 * both >= percent * (len(mine) + len(other) - both))
            last, kept = texts[-1], theirs[-1]
            good = np.asarray(good)
            yield pa.record_batch({"a": pa.array(a[good]), "b": pa.array(b[good])})

    return run


def _links(docs: DataFrame, pairs: DataFrame, k: int, percent: int, parts: int) -> DataFrame:
    """Pairs of ids whose texts are similar. Each text goes to the pairs it is part of, and no other is moved."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    dealt = by_marks(docs, ids)[0].repartition(parts, "doc_id")
    right = dealt.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    left = dealt.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(_compare(k, percent), "a long, b long")


def jaccard_classes(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85, blocks: int | None = None
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each row of ``docs``.

    Words are the runs of non-blank characters, A-Z taken as a-z, and a text's set is its distinct ``k``-word
    shingles (its whole sequence, if it has fewer words). Two texts link when 100 * intersection >= percent *
    union. ``component_id`` is the smallest id reachable by links, itself included.

    A null, empty or blank text has an empty set and links with nothing. Rows that repeat an id are one node with
    all their links. A row whose id is null links with nothing and has a null component. An empty table gives an
    empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks or 4 * parts
    docs = X.only(docs, id_column, text)
    kinds = "doc_id long, n long, one long, two long, flips binary, piece int, counts binary"
    survey = stored(docs.mapInArrow(_survey(k), kinds), "survey")
    table = spark.sparkContext.broadcast(column_classes(survey))
    sizes = survey.where("piece is null").select("doc_id", "n", "one", "two", "flips")
    full = sizes.where("doc_id is not null and n > 0")
    # The first id of each class stands for it.
    classes = stored(full.groupBy("n", "one", "two").agg(F.min("doc_id").alias("first"), F.first("flips").alias("flips")), "classes")
    member = full.select("doc_id", "n", "one", "two").join(classes.drop("flips"), ["n", "one", "two"])
    named = stored(member.select("doc_id", "first").distinct(), "named")

    entries = docs.mapInArrow(_entries(k, percent, blocks, table), "bucket int, records binary")
    product = stored(
        X.by_bucket(entries, blocks).mapInArrow(_product(percent, parts), "bucket int, records binary, wide boolean"), "product"
    )
    pairs = X.by_bucket(product.where("not wide").select("bucket", "records"), parts).mapInArrow(_distinct, "a long, b long")

    # Pairs of fingerprints become pairs of classes.
    def of(end: str) -> DataFrame:
        return classes.select(F.col("two").alias(end), F.col("first").alias(f"first_{end}"), F.col("n").alias(f"n_{end}"), F.col("flips").alias(f"flips_{end}"))

    pairs = pairs.join(of("a"), "a").join(of("b"), "b").where("first_a != first_b")
    pairs = pairs.select(F.least("first_a", "first_b").alias("a"), F.greatest("first_a", "first_b").alias("b"), "n_a", "n_b", "flips_a", "flips_b")
    pairs = stored(pairs.mapInArrow(_by_flips(percent), "a long, b long").distinct(), "pairs")
    ends = pairs.groupBy("b").agg(F.min("a").alias("low"), F.max("a").alias("high"))
    begun = stored(ends.select(F.col("low").alias("a"), "b").union(ends.where("low < high").select("high", "b")), "begun")
    links = stored(_links(docs, begun, k, percent, parts), "found")
    # Rows that repeat an id with different texts tie their classes together.
    ties = named.groupBy("doc_id").agg(F.min("first").alias("a"), F.max("first").alias("b")).where("a != b")
    ties = named.join(ties.select("doc_id", "a"), "doc_id").where("a != first").select("a", F.col("first").alias("b"))
    links = links.union(ties)
    labels = components(links)

    # What other pairs and wide columns may still hide: pairs in different components.
    low, high = (labels.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}")) for x in "ab")
    other = pairs.join(begun, ["a", "b"], "left_anti").join(low, "a", "left").join(high, "b", "left")
    other = other.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")
    where = classes.join(labels, classes["first"] == labels["node"], "left")
    where = where.select("two", F.col("first").alias("node"), F.coalesce("component", "first").alias("component"))
    wide = product.where("wide").select("records").mapInArrow(_unpack_entries, "key long, doc long, n long, at long")
    wide = wide.join(where, wide["doc"] == where["two"]).select("key", "two", "node", (F.col("n") - F.col("at")).alias("rest"), "component")
    mixed = wide.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("key")
    wide = stored(wide.join(mixed, "key", "left_semi"), "wide")
    if not wide.isEmpty():
        rows = wide.join(classes.select("two", "n", "flips"), "two").select("key", "node", "n", "rest", "component", "flips")
        hidden = rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_across(percent), "a long, b long")
        other = other.union(hidden.distinct().join(begun, ["a", "b"], "left_anti"))
    other = stored(other.distinct(), "pairs")
    if not other.isEmpty():
        labels = components(links.union(stored(_links(docs, other, k, percent, parts), "found")))

    of_class = named.join(labels, named["first"] == labels["node"], "left")
    of_id = of_class.groupBy("doc_id").agg(F.min(F.coalesce("component", "first")).alias("component_id"))
    return sizes.join(of_id, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
