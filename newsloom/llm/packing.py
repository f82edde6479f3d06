"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt to partitions, and each packs its own
best-fit, longest first. Nearly full bins are final. The emptiest of the others go on as items: groups of partitions
are merged, and the bins that reach a group are packed best-fit again, level by level up to one group.

Of two bins of a best-fit packing, no two fit together, so a group has at most one bin that is not more than half full,
and more than half full bins never fit together later on either. What a merge of ``FAN_IN`` groups can still save is
that each group's one small bin goes into a room of another group: at most ``FAN_IN`` rooms are used at each level, and
if a small bin fits any room, it fits the largest. So of a group, its ``FAN_IN`` emptiest bins for each level to come
are all that any later level may use. ``FORWARD`` is that number for 64 levels, more than any table has: passing on more
would save no sequence, and the last task of the tree stays small at any size of the input.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import texts as X
from newsloom.session import stored

# Bytes of text tokenised at a time.
SLICE = 1 << 20
# Items that one task packs, groups merged at a time, and bins that a group passes on, the emptiest.
ITEMS = 50_000
FAN_IN = 8
FORWARD = 64 * FAN_IN

_LETTER, _NUMBER, _SPACE, _OTHER = range(4)


def _character_classes() -> np.ndarray:
    """The class of each code point in the vocabulary's splitting pattern."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        found = "".join(regex.findall(pattern + "+", every))
        out[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return out


class Tokens:
    """Token ids of many texts at once, by a byte-level BPE vocabulary file.

    The vocabulary splits a text into words before any merge, so a word has the same ids everywhere. Words are found
    in arrays of code points and looked up by a 64-bit hash; only words not seen before go through the tokenizer's
    merges. At most ``limit`` words are remembered.

    That holds for files that split as ``word_starts`` does and do not normalise; with others, texts go through the
    tokenizer itself. ``encode`` takes a text as ordinary words; ``encode_with_added`` first looks for the tokens that the file adds to
    its vocabulary, as the tokenizer does when it is loaded.
    """

    limit = 1 << 21

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        # The longest of those that begin at a place.
        self.split = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        # Tokens that look at what is around them are left to the tokenizer.
        self.plain = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values())
        self.loaded = Tokenizer.from_file(path)
        file = json.loads(self.loaded.to_str())
        split = file["pre_tokenizer"] or {}
        known = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        self.known = known and not file["normalizer"] and file["model"]["type"] == "BPE" and not file["model"].get("dropout")
        self.classes = _character_classes()
        # Byte-level vocabularies write printable bytes as themselves and the others as code points from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.words = X.Words()
        self.values = np.random.default_rng(3).integers(1, 1 << 63, 0x110000, dtype=np.uint64)
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def word_starts(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the words of the splitting pattern begin: ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
        ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``. Words do not cross ``bounds``."""
        n = len(points)
        kind = self.classes[points]
        cut = np.zeros(n + 3, bool)
        cut[0] = True
        cut[1:n] = kind[1:] != kind[:-1]
        edge = np.zeros(n + 3, bool)
        edge[bounds] = True
        cut |= edge
        # The last of some white space before a word is apart from the rest; a blank belongs to the word.
        last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~edge[1:n])
        cut[last] = True
        cut[last[points[last] == 32] + 1] = False
        # Contractions, where an apostrophe begins a word.
        padded = np.append(points, np.zeros(3, points.dtype))
        quote = np.flatnonzero((points == 39) & cut[:n])
        quote = quote[~edge[quote + 1]]
        one, two = padded[quote + 1], padded[quote + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ~edge[quote + 2] & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
        cut[quote[single | double] + 1] = False
        cut[quote[single] + 2] = True
        cut[quote[double] + 3] = True
        return np.flatnonzero(cut[:n])

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        if len(self.hashes) + len(hashes) > self.limit:
            self.clear()
        tokenize, letters = self.model.tokenize, self.letters
        found = [[t.id for t in tokenize(w.encode().decode("latin-1").translate(letters))] for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate((self.ids, np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum()))))
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.starts, self.sizes = (
            np.insert(a, at, b) for a, b in ((self.hashes, hashes), (self.starts, starts), (self.sizes, sizes))
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        joined = "".join(texts)
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        if not joined:
            return [np.zeros(0, np.uint32)] * len(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        starts = self.word_starts(points, bounds)
        ends = np.append(starts[1:], len(points))
        self.words._grow(len(points))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.values[points] * self.words.powers[: len(points)])))
        hashes = X.mix((sums[ends] - sums[starts]) * self.words.inverses[starts])
        kinds, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, kinds), max(0, len(self.hashes) - 1))
        new = self.hashes[at] != kinds if len(self.hashes) else np.ones(len(kinds), bool)
        if new.any():
            if len(self.hashes) + int(new.sum()) > self.limit:
                self.clear()
                new[:] = True
            spots = first[new]
            self._learn(kinds[new], [joined[a:b] for a, b in zip(starts[spots].tolist(), ends[spots].tolist(), strict=True)])
            at = np.searchsorted(self.hashes, kinds)
        at = at[which]
        sizes, begin = self.sizes[at], self.starts[at]
        total = np.cumsum(sizes)
        ids = self.ids[np.repeat(begin - total + sizes, sizes) + np.arange(int(total[-1]))]
        cuts = np.concatenate(([0], total))[np.searchsorted(starts, bounds)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


    def encode_with_added(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with those of the file's added tokens where their names stand."""
        if not self.known:
            return [np.asarray(e.ids, np.uint32) for e in self.loaded.encode_batch(texts, add_special_tokens=False)]
        special = [i for i, t in enumerate(texts) if self.split.search(t)]
        if not special:
            return self.encode(texts)
        if not self.plain:
            out = self.encode(texts)
            for i in special:
                out[i] = np.asarray(self.loaded.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            return out
        parts, names = [self.split.split(t) for t in texts], [self.split.findall(t) for t in texts]
        found, out = iter(self.encode([p for x in parts for p in x])), []
        for some in names:
            ids = [next(found)]
            for name in some:
                ids += [np.asarray([self.added[name]], np.uint32), next(found)]
            out.append(np.concatenate(ids))
        return out


def _cut(path: str, capacity: int, end: int):
    """Token ids of each text and their pieces. Pieces get a number of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = X.kept_in_process(f"tokens of {path}", lambda: Tokens(path))
        number = TaskContext.get().partitionId() << 40
        for batch in X.slices(batches, size=SLICE):
            rows, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(tokens.encode_with_added(X.column(batch, "text").to_pylist())):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                n = -(-len(ids) // capacity)
                a = 0
                for k in range(n):
                    b = len(ids) - (n - 1 - k) * capacity
                    rows.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b]))
                    a = b
            yield pa.record_batch(
                {
                    "item": pa.array(number + np.arange(len(rows))),
                    "doc_id": X.column(batch, "doc_id").take(pa.array(rows)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )
            number += len(rows)

    return run


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item in the given order, and the length of each bin.

    Each item goes to the bin it leaves least room in. Which rooms exist is kept as bits of a number, so the
    smallest room that is large enough is its lowest bit above the size.
    """
    rooms: dict[int, list[int]] = {}
    exist, lengths, bins, offsets = 0, [], [], []
    for size in sizes:
        above = exist >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            spots = rooms[room]
            b = spots.pop()
            if not spots:
                exist &= ~(1 << room)
        else:
            b, room = len(lengths), capacity
            lengths.append(0)
        bins.append(b)
        offsets.append(lengths[b])
        lengths[b] += size
        room -= size
        if room:
            rooms.setdefault(room, []).append(b)
            exist |= 1 << room
    return bins, offsets, lengths


def _pack(capacity: int, slack: int, level: int, last: bool):
    """Pack the items of this task's group; say which of its bins go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        group, item, length = (t[c].to_numpy() for c in ("group", "item", "length"))
        for g in np.unique(group):  # several groups may share a task
            mine = np.flatnonzero(group == g)
            mine = mine[np.lexsort((item[mine], -length[mine]))]
            bins, offsets, lengths = best_fit(length[mine].tolist(), capacity)
            lengths = np.asarray(lengths)
            onward = np.zeros(len(lengths), bool)
            if not last:
                onward[np.argsort(lengths, kind="stable")[:FORWARD]] = True
                onward &= lengths < capacity - slack
            name = (np.int64(level) << 56) | (np.int64(g) << 32)
            yield pa.record_batch(
                {
                    "item": pa.array(item[mine]),
                    "bin": pa.array(name + np.asarray(bins, np.int64)),
                    "offset": pa.array(offsets, pa.int64()),
                    "total": pa.array(lengths[bins]),
                    "onward": pa.array(onward[bins]),
                    "lead": pa.array(np.asarray(offsets) == 0),
                    "group": pa.array(np.full(len(mine), g // FAN_IN), pa.int32()),
                }
            )

    return run


def pack(items: DataFrame, capacity: int, slack: int = 16, per_task: int = ITEMS) -> DataFrame:
    """Rows (item, sequence_id, offset) for rows (item, length) with unique items of 1 to ``capacity``."""
    n = max(1, -(-items.count() // per_task))
    groups = items.select("item", "length", F.pmod(F.xxhash64("item"), F.lit(n)).cast("int").alias("group"))
    level, placed = 0, None
    while True:
        rows = "item long, bin long, offset long, total long, onward boolean, lead boolean, group int"
        packed = stored(groups.repartition(n, "group").mapInArrow(_pack(capacity, slack, level, n == 1), rows), "bins")
        found = packed.select("item", "bin", "offset")
        if placed is None:
            placed = found
        else:
            higher = found.select(F.col("item").alias("bin"), F.col("bin").alias("above"), F.col("offset").alias("more"))
            placed = placed.join(higher, "bin", "left").select(
                "item", F.coalesce("above", "bin").alias("bin"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset")
            )
        if n == 1:
            return placed.select("item", F.col("bin").alias("sequence_id"), "offset")
        groups = packed.where("onward and lead").select(F.col("bin").alias("item"), F.col("total").alias("length"), "group")
        n, level = -(-n // FAN_IN), level + 1


def packed_sequences(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", capacity: int = 2048, end: int = 0
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one for each piece of a document.

    A document's ids are those of the vocabulary file ``tokenizer`` (a path), then ``end``. Only a document of more
    than ``capacity`` ids is cut: all pieces but the first have ``capacity`` ids. Pieces of a sequence lie one after
    the other from 0 on. A name of one of the file's added tokens in a text is that token, special or not.

    A null or empty text is the one id ``end``. Each of several rows with the same or a null id is a document of its
    own. An empty table gives an empty result. Other columns are not read.
    """
    pieces = X.only(docs, id_column, text).mapInArrow(
        _cut(tokenizer, capacity, end), "item long, doc_id long, piece int, start long, length long, ids_crc32 long"
    )
    pieces = stored(pieces, "pieces")
    return pieces.join(pack(pieces.select("item", "length"), capacity), "item").drop("item")
