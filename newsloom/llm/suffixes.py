"""Exact removal of repeated passages by column-wise construction over a collection of text pieces.

The construction inserts one symbol per piece each round, from the last column to the first, and keeps two columns
that are read and rewritten in sequence: the pieces in the order of their suffixes (whose symbols are that round's
column of the collection's Burrows-Wheeler transform) and the common prefix of each suffix with the one before it.

A whole corpus has as many rounds as its longest text has bytes, and each round would pass over everything. So texts
are first cut into pieces that bound the rounds and can be spread over tasks:

1. Every window of ``length`` bytes has an anchor: its k-gram of smallest hash. Equal windows have equal anchors, at
   the same place. Anchors that occur once in the corpus cannot be part of a repeat; their windows stay.
2. Neighbouring windows with the same anchor are one piece of less than ``2 * length`` bytes. Pieces meet by anchor
   hash, aligned on the anchor: equal windows start in the same column, so a round only compares the suffixes it
   inserts, and the columns of a round replace those of the round before. The files between the rounds of cutting,
   meeting and removal are Spark's shuffle files.
3. In each column, suffixes that share ``length`` symbols are neighbours in order. All but the earliest are repeats.

Equal pieces are one piece before they are shuffled. An anchor with very many pieces (a passage of many texts) is cut
further, into single windows, whose key is the window itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import texts as X
from newsloom.session import stored

# Anchors with at least this many occurrences are cut into single windows; at most HOT_TABLE of them, the most frequent.
HOT = 2000
HOT_TABLE = 1 << 16
# Entries, and bytes of pieces, that a task holds before it passes them on.
HELD = 1 << 19
HELD_BYTES = 1 << 22
# Bytes of pieces that share the rounds of a construction; pieces of one key always do.
ROUND_BYTES = 1 << 20
# Bytes of text per slice, and windows per tile of a longer text: a place in a tile takes 24 bits.
SLICE = 1 << 18
TILE = 1 << 23

_ANCHOR = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("count", "<i8")])
_PIECE = np.dtype([("key", "<u8"), ("doc", "<i8"), ("at", "<i8"), ("left", "<i4"), ("size", "<i4")])
_MARK = np.dtype([("doc", "<i8"), ("start", "<i8"), ("end", "<i8")])
_ROWS = "bucket int, kind int, records binary, bytes binary"
_ENTRY, _KNOWN, _FREQUENT, _PIECES, _MARKS = range(5)
_PLACE = np.uint64((1 << 24) - 1)
_RANDOM = np.random.default_rng(11).integers(1, 1 << 63, (3, 256), dtype=np.uint64)
_FACTORS = [int(x) | 1 for x in np.random.default_rng(12).integers(1, 1 << 63, 64)]


class Fingerprints:
    """128-bit hashes of stretches of a byte array."""

    def __init__(self) -> None:
        self.words = X.Words()

    def __call__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(data) <= 2 * SLICE or (start[1:] < start[:-1]).any():
            return self._all(data, start, size)
        # Stretches in order: a part of them, and of the bytes, at a time.
        cuts = np.flatnonzero(np.diff(start // SLICE, prepend=-1))
        parts = []
        for i, j in zip(cuts, np.append(cuts[1:], len(start)), strict=True):
            low = int(start[i])
            parts.append(self._all(data[low : int((start[i:j] + size[i:j]).max())], start[i:j] - low, size[i:j]))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _all(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.words._grow(len(data))
        out = []
        for values in _RANDOM[1:]:
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[data] * self.words.powers[: len(data)])))
            out.append(X.mix((sums[start + size] - sums[start]) * self.words.inverses[start]))
        return out[0], out[1]


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` bytes from each place on, by doubling."""
    h, width, out, done, level = _RANDOM[0][data], 1, None, 0, 0
    while True:
        if k & width:
            n = len(data) - done - width + 1
            out = h[:n] if out is None else out[:n] * np.uint64(_FACTORS[32 + level]) + h[done : done + n]
            done += width
        if 2 * width > k:
            return X.mix(out)
        h = h[:-width] * np.uint64(_FACTORS[level]) + h[width:]
        width, level = 2 * width, level + 1


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each ``w`` neighbours."""
    n, width = len(x) - w + 1, 1
    while 2 * width <= w:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:n], x[w - width : w - width + n])


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of ``length`` bytes with the same anchor: its hash and place, their first and last start.

    Of several smallest k-grams in a window the leftmost is the anchor. Windows do not cross ``bounds``.
    """
    empty = np.zeros(0, np.int64)
    found = []
    for top in range(0, max(0, len(data) - length + 1), TILE):
        tile = data[top : top + TILE + length - 1]
        n = len(tile) - length + 1
        h = _gram_hashes(tile, k)
        least = _sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - k + 1) & _PLACE
        place = least.astype(np.int64)
        inside = np.ones(n, bool)
        for end in bounds[(bounds > top) & (bounds < top + n + length - 1)] - top:
            inside[max(0, end - length + 1) : end] = False
        turns = np.flatnonzero((place[1:] != place[:-1]) | (inside[1:] != inside[:-1])) + 1
        first = np.concatenate(([0], turns))
        last = np.append(turns, n) - 1
        good = inside[first]
        first, last = first[good], last[good]
        spot = place[first]
        found.append((h[spot], spot + top, first + top, last + top))
    if not found:
        return np.zeros(0, np.uint64), empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _rows(kind: int, buckets: np.ndarray, records: np.ndarray, data: np.ndarray | None = None) -> pa.RecordBatch:
    """Records, and the bytes of pieces, as one row per bucket."""
    order = np.argsort(buckets, kind="stable")
    buckets, records = buckets[order], records[order]
    cuts = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1]))) if len(buckets) else np.zeros(0, int)
    ends = np.append(cuts[1:], len(buckets))[: len(cuts)]
    if data is not None:
        starts = (np.cumsum(records["size"], dtype=np.int64) - records["size"])  # in the new order
        old = data[0][order]
        index = np.repeat(old - starts, records["size"]) + np.arange(int(records["size"].sum()))
        data = data[1][index]
        starts = np.append(starts, len(data))
        blobs = [pa.compress(data[starts[a] : starts[b]].tobytes(), "zstd", asbytes=True) for a, b in zip(cuts, ends, strict=True)]
    return pa.record_batch(
        {
            "bucket": pa.array(buckets[cuts].astype(np.int32), pa.int32()),
            "kind": pa.array(np.full(len(cuts), kind, np.int32)),
            "records": pa.array([records[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
            "bytes": pa.nulls(len(cuts), pa.binary()) if data is None else pa.array(blobs, pa.binary()),
        }
    )


def _bucket(x: np.ndarray, n: int) -> np.ndarray:
    return (X.mix(x.astype(np.uint64)) % np.uint64(n)).astype(np.int32)


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins in sorted arrays."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in keys])
    return new


def _find_anchors(length: int, k: int, blocks: int):
    """Anchors of all texts. Those that occur twice within a task are known to repeat; one entry of them goes on."""

    def passed(hashes: list, docs: list) -> Iterator[pa.RecordBatch]:
        h, d = np.concatenate(hashes), np.concatenate(docs)
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        starts = np.flatnonzero(_firsts(h))
        counts = np.diff(np.append(starts, len(h)))
        entry = np.zeros(len(starts), _ANCHOR)
        entry["hash"], entry["doc"], entry["count"] = h[starts], d[starts], counts
        yield _rows(_ENTRY, _bucket(entry["hash"], blocks), entry)
        again = np.repeat(counts > 1, counts) & _firsts(h, d)
        known = np.zeros(int(again.sum()), _ANCHOR)
        known["hash"], known["doc"] = h[again], d[again]
        if len(known):
            yield _rows(_KNOWN, _bucket(known["doc"], blocks), known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, docs, held = [], [], 0
        for batch in X.slices(batches, size=SLICE):
            data, bounds = X.utf8(X.column(batch, "text"))
            h, _, first, _ = anchors(data, bounds, length, k)
            hashes.append(h)
            docs.append(X.longs(batch, "at")[np.searchsorted(bounds, first, "right") - 1])
            held += len(h)
            if held >= HELD:
                yield from passed(hashes, docs)
                hashes, docs, held = [], [], 0
        if held:
            yield from passed(hashes, docs)

    return run


def _repeated(parts: int):
    """Anchors of a block that occur more than once, by document, and the frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = []
        for batch in batches:
            for kind, cell in zip(X.column(batch, "kind").to_pylist(), X.column(batch, "records"), strict=True):
                records = np.frombuffer(cell.as_buffer(), _ANCHOR)
                if kind == _KNOWN:
                    yield _rows(_KNOWN, _bucket(records["doc"], parts), records)
                else:
                    entries.append(records)
        if not entries:
            return
        e = np.concatenate(entries)
        e = e[np.argsort(e["hash"], kind="stable")]
        starts = np.flatnonzero(_firsts(e["hash"]))
        total = np.add.reduceat(e["count"], starts)
        many = np.repeat(total, np.diff(np.append(starts, len(e))))
        new = e[(many > 1) & (e["count"] == 1)]
        if len(new):
            yield _rows(_KNOWN, _bucket(new["doc"], parts), new)
        frequent = e[starts][total >= HOT]
        frequent["count"] = total[total >= HOT]
        if len(frequent):
            yield _rows(_FREQUENT, np.zeros(len(frequent), np.int32), frequent)

    return run


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    e = X.unpacked(batches, _ANCHOR)
    yield pa.record_batch({"hash": pa.array(e["hash"].view(np.int64)), "n": pa.array(e["count"])})


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeated anchors of each document as one cell."""
    e = X.unpacked(batches, _ANCHOR)
    e = e[np.lexsort((e["hash"], e["doc"]))]
    e = e[_firsts(e["hash"], e["doc"])]
    starts = np.flatnonzero(_firsts(e["doc"]))
    ends = np.append(starts[1:], len(e))[: len(starts)]
    hashes = np.ascontiguousarray(e["hash"])
    for top in range(0, len(starts), 4096):
        a, b = starts[top : top + 4096], ends[top : top + 4096]
        cells = [hashes[x:y].tobytes() for x, y in zip(a, b, strict=True)]
        yield pa.record_batch({"at": pa.array(e["doc"][a]), "hashes": pa.array(cells, pa.binary())})


def union_of_spans(marks: np.ndarray) -> np.ndarray:
    """Maximal runs of bytes, by document: touching and overlapping marks are joined."""
    if not len(marks):
        return marks
    marks = marks[np.lexsort((marks["start"], marks["doc"]))]
    step = int(marks["end"].max()) + 2
    base = np.cumsum(_firsts(marks["doc"])).astype(np.int64) * step
    reach = np.maximum.accumulate(base + marks["end"])
    new = np.ones(len(marks), bool)
    new[1:] = base[1:] + marks["start"][1:] > reach[:-1]
    starts = np.flatnonzero(new)
    out = marks[starts]
    out["end"] = (reach - base)[np.append(starts[1:], len(marks)) - 1]
    return out


def _equal_pieces(pieces: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first piece of each group of equal ones, and the marks of the others: all their windows repeat."""
    order = np.lexsort((pieces["at"], pieces["doc"], pieces["size"], pieces["left"], two, one, pieces["key"]))
    p = pieces[order]
    first = _firsts(p["key"], one[order], two[order], p["left"], p["size"])
    rest = p[~first]
    marks = np.zeros(len(rest), _MARK)
    marks["doc"], marks["start"] = rest["doc"], rest["at"] - rest["left"]
    marks["end"] = marks["start"] + rest["size"]
    return order[first], union_of_spans(marks)


def _cut_pieces(length: int, k: int, blocks: int, hot):
    """The pieces of repeated anchors, dealt to blocks by their key; equal ones of a task go on once."""
    fingerprints = Fingerprints()

    def passed(pieces: list, data: list) -> Iterator[pa.RecordBatch]:
        p, text = np.concatenate(pieces), np.concatenate(data)
        starts = np.cumsum(p["size"], dtype=np.int64) - p["size"]
        keep, marks = _equal_pieces(p, *fingerprints(text, starts, p["size"]))
        yield _rows(_PIECES, _bucket(p["key"][keep], blocks), p[keep], (starts[keep], text))
        if len(marks):
            yield _rows(_MARKS, _bucket(marks["doc"], blocks), marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = hot.value
        pieces, texts, held = [], [], 0
        for batch in X.slices(batches, size=SLICE):
            data, bounds = X.utf8(X.column(batch, "text"))
            h, place, first, last = anchors(data, bounds, length, k)
            row = np.searchsorted(bounds, first, "right") - 1
            lists = [np.frombuffer(x.as_buffer(), "<u8") for x in X.column(batch, "hashes")]
            of = np.repeat(np.arange(len(lists)), [len(x) for x in lists]).astype(np.uint64)
            wanted = np.unique(X.mix(np.concatenate(lists) ^ X.mix(of + np.uint64(1))))
            mine = np.flatnonzero(np.isin(X.mix(h ^ X.mix(row.astype(np.uint64) + np.uint64(1))), wanted))
            if not len(mine):
                continue
            h, place, first, last, row = h[mine], place[mine], first[mine], last[mine], row[mine]
            often = np.isin(h, frequent)
            windows = (last - first + 1)[often]
            start = np.repeat(first[often] - np.cumsum(windows) + windows, windows) + np.arange(int(windows.sum()))
            n = int((~often).sum())
            p = np.zeros(n + len(start), _PIECE)
            begin = np.concatenate((first[~often], start))
            owner = np.concatenate((row[~often], np.repeat(row[often], windows)))
            p["size"] = length
            p["size"][:n] += (last - first)[~often].astype(np.int32)
            p["left"][:n] = (place - first)[~often]
            p["doc"] = X.longs(batch, "at")[owner]
            p["at"] = begin + p["left"] - bounds[owner]
            one, two = fingerprints(data, begin, p["size"])
            p["key"][:n], p["key"][n:] = h[~often], X.mix(one[n:])
            keep, marks = _equal_pieces(p, one, two)
            if len(marks):
                yield _rows(_MARKS, _bucket(marks["doc"], blocks), marks)
            p, begin = p[keep], begin[keep]
            sizes = p["size"].astype(np.int64)
            total = int(sizes.sum())
            pieces.append(p)
            texts.append(data[np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(total)])
            held += total
            if held >= HELD_BYTES:
                yield from passed(pieces, texts)
                pieces, texts, held = [], [], 0
        if held:
            yield from passed(pieces, texts)

    return run


def repeated_windows(left: np.ndarray, size: np.ndarray, text: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """For each piece and window, counted from the piece's start, whether an equal window has a smaller rank.

    Pieces are aligned at ``left``. Symbols are inserted column by column from the right. ``order`` holds the pieces
    that reach the column, by suffix, and ``common`` the prefix that each shares with the one before.
    """
    n, size = len(left), size.astype(np.int64)
    left = left.astype(np.int64)
    most, right = int(left.max()), int((size - left).max())
    columns = np.zeros((most + right, n), np.uint8)  # one sequential file of symbols per column
    starts = np.cumsum(size) - size
    of = np.repeat(np.arange(n), size)
    columns[np.arange(len(text)) - np.repeat(starts - (most - left), size), of] = text
    repeats = np.zeros((n, int((size - length).max()) + 2), bool)
    enter = np.argsort(left - size, kind="stable")  # the pieces that reach furthest first
    reach = (size - left)[enter]
    waiting = 0
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int16)
    for c in range(right - 1, -most - 1, -1):
        more = int(np.searchsorted(-reach, -c, "left")) - waiting  # those whose last symbol is in this column
        if more > 0:
            order = np.concatenate((enter[waiting : waiting + more], order))
            common = np.concatenate((np.zeros(more, np.int16), common))
            if len(common) > more:
                common[more] = 0
            waiting += more
        if c < 0:
            stay = left[order] >= -c
            if not stay.all():
                kept = np.flatnonzero(stay)
                if not len(kept):
                    order, common = order[:0], common[:0]
                    continue
                common = np.minimum.reduceat(common[: kept[-1] + 1], np.concatenate(([0], kept[:-1] + 1)))
                common[0] = 0
                order = order[kept]
        if not len(order):
            continue
        symbols = columns[c + most][order]
        by = np.argsort(symbols, kind="stable")
        least = np.minimum.reduceat(np.append(common, np.int16(0)), by + 1)
        order, symbols = order[by], symbols[by]
        common = np.zeros(len(order), np.int16)
        common[1:] = np.where(symbols[1:] == symbols[:-1], least[:-1] + 1, 0)
        if c <= 0:
            long = common >= length
            if long.any():
                heads = np.flatnonzero(~long)
                earliest = np.minimum.reduceat(rank[order], heads)
                again = order[rank[order] != np.repeat(earliest, np.diff(np.append(heads, len(order))))]
                repeats[again, c + left[again]] = True
    return repeats


def _construct(length: int, parts: int):
    """The repeats among the pieces of a block, as marks, packed by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, texts = [], []
        for batch in batches:
            cells = zip(X.column(batch, "kind").to_pylist(), X.column(batch, "records"), X.column(batch, "bytes"), strict=True)
            for kind, records, data in cells:
                if kind == _MARKS:
                    marks = np.frombuffer(records.as_buffer(), _MARK)
                    yield _rows(_MARKS, _bucket(marks["doc"], parts), marks)
                else:
                    pieces.append(np.frombuffer(records.as_buffer(), _PIECE))
                    n = int(pieces[-1]["size"].sum(dtype=np.int64))
                    texts.append(np.frombuffer(pa.decompress(data.as_buffer(), n, "zstd"), np.uint8))
        if not pieces:
            return
        p, text = np.concatenate(pieces), np.concatenate(texts)
        del pieces, texts
        starts = np.cumsum(p["size"], dtype=np.int64) - p["size"]
        keep, marks = _equal_pieces(p, *Fingerprints()(text, starts, p["size"]))
        found = [marks]
        # Pieces of one key are a collection of their own; many small ones share a round.
        p, starts = p[keep], starts[keep]
        alone = _firsts(p["key"])
        alone &= np.append(alone[1:], True)  # its only piece: nothing to compare with
        p, starts = p[~alone], starts[~alone]
        while len(p):
            n = max(1, int(np.searchsorted(np.cumsum(p["size"], dtype=np.int64), ROUND_BYTES, "right")))
            while n < len(p) and p["key"][n] == p["key"][n - 1]:
                n += 1
            now, at = p[:n], starts[:n]
            sizes = now["size"].astype(np.int64)
            data = text[np.repeat(at - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]
            rank = np.empty(n, np.int64)
            rank[np.lexsort((now["at"], now["doc"]))] = np.arange(n)
            repeats = repeated_windows(now["left"], sizes, data, rank, length)
            turns = np.flatnonzero(np.diff(repeats.ravel().astype(np.int8), prepend=np.int8(0)))
            begin, end = turns[::2], turns[1::2]  # the last column is never set, so runs end within their row
            piece, first = np.divmod(begin, repeats.shape[1])
            marks = np.zeros(len(begin), _MARK)
            marks["doc"] = now["doc"][piece]
            marks["start"] = now["at"][piece] - now["left"][piece] + first
            marks["end"] = marks["start"] + (end - begin) - 1 + length
            found.append(marks)
            p, starts = p[n:], starts[n:]
        marks = union_of_spans(np.concatenate(found))
        if len(marks):
            yield _rows(_MARKS, _bucket(marks["doc"], parts), marks)

    return run


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The removed runs of each document as one cell of starts and ends."""
    marks = union_of_spans(X.unpacked(batches, _MARK))
    starts = np.flatnonzero(_firsts(marks["doc"]))
    ends = np.append(starts[1:], len(marks))[: len(starts)]
    pairs = np.stack((marks["start"], marks["end"]), axis=1)
    for top in range(0, len(starts), 4096):
        a, b = starts[top : top + 4096], ends[top : top + 4096]
        cells = [pairs[x:y].tobytes() for x, y in zip(a, b, strict=True)]
        yield pa.record_batch({"at": pa.array(marks["doc"][a]), "spans": pa.array(cells, pa.binary())})


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the removed runs out of each text."""
    for batch in X.slices(batches):
        kept, removed, count = [], [], []
        for text, spans in zip(X.column(batch, "text"), X.column(batch, "spans"), strict=True):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            runs = np.frombuffer(spans.as_buffer(), "<i8").reshape(-1, 2) if spans.is_valid else np.zeros((0, 2), np.int64)
            at, parts = 0, []
            for a, b in runs.tolist():
                parts.append(data[at:a])
                at = b
            parts.append(data[at:])
            kept.append(b"".join(parts))
            removed.append(int((runs[:, 1] - runs[:, 0]).sum()))
            count.append(len(runs))
        yield pa.record_batch(
            {
                "at": X.column(batch, "at"),
                "carry": X.column(batch, "carry"),
                "n_bytes": pa.array([len(x) + r for x, r in zip(kept, removed, strict=True)], pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(count, pa.int64()),
                "kept": pa.array(kept, pa.binary()),
            }
        )


def numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Add ``at``, a number per row that orders rows by id (null first), then text; and whether it is the id itself.

    It is where ids are unique. Else rows are numbered in a range-partitioned sort; equal rows are interchangeable.
    """
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return docs.withColumn("at", F.col("doc_id")), True
    ordered = docs.orderBy(F.col("doc_id").asc_nulls_first(), "text")
    return stored(ordered.withColumn("at", F.monotonically_increasing_id()), "numbered"), False


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = 100, k: int = 40, carry: Sequence[str] = ()
) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept) with columns ``carry``: each text without the bytes that repeat.

    A byte is removed if a string of ``length`` bytes that covers it also starts earlier: in a row of smaller id, or
    earlier in the same text. Overlaps count, and strings are judged on the input. ``kept`` holds the remaining bytes.

    A null or empty text has no bytes; a text shorter than ``length`` is kept whole. Rows that repeat an id are
    documents of their own, in the order of their texts; rows with a null id come first. Of equal rows one is taken to
    be earlier. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = 4 * parts
    carried = F.struct(*(F.col(f"`{c}`") for c in carry) if carry else [F.lit(True).alias("none")])
    docs, same = numbered(X.only(docs.withColumn("carry", carried), id_column, text, "carry"))
    entries = docs.select("at", "text").mapInArrow(_find_anchors(length, k, blocks), _ROWS)
    found = stored(X.by_bucket(entries, blocks).mapInArrow(_repeated(parts), _ROWS), "anchors")
    frequent = found.where(F.col("kind") == _FREQUENT).select("records").mapInArrow(_frequent, "hash long, n long")
    top = frequent.orderBy(F.desc("n"), "hash").limit(HOT_TABLE).toArrow()
    hot = spark.sparkContext.broadcast(np.sort(top["hash"].to_numpy().view(np.uint64)))
    known = X.by_bucket(found.where(F.col("kind") == _KNOWN).select("bucket", "records"), parts)
    dealt = docs.where("at is not null").select("at", "text", "carry").repartition(parts, "at")  # both joins use one shuffle
    cells = known.mapInArrow(_by_document, "at long, hashes binary").repartition(parts, "at")
    pieces = dealt.join(cells.hint("shuffle_hash"), "at").mapInArrow(_cut_pieces(length, k, blocks, hot), _ROWS)
    marks = X.by_bucket(pieces, blocks).mapInArrow(_construct(length, parts), _ROWS)
    spans = X.by_bucket(marks.select("bucket", "records"), parts).mapInArrow(_spans, "at long, spans binary")
    joined = dealt.join(spans.repartition(parts, "at").hint("shuffle_hash"), "at", "left")
    shape = docs.schema["carry"].dataType.simpleString()
    cut = joined.mapInArrow(_remove, f"at long, carry {shape}, n_bytes long, n_removed long, n_spans long, kept binary")
    cut = cut.withColumnRenamed("at", "doc_id") if same else docs.select("doc_id", "at").join(cut, "at")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept", *(F.col(f"carry.`{c}`") for c in carry))
