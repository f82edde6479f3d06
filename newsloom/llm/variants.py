"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One inserted or deleted letter changes the letter counts of a word by 1 in all, one replaced letter by 2 at most: one
count goes up, one goes down. So words near each other are near in the space of letter counts, whatever the order of
their letters.

1. Words are counted by a grouped aggregation.
2. Words of one length are points of one k-d tree. Its upper levels, split at the medians of a sample, cut the words of
   a length into cells of about ``CELL`` words. A word lives in the cell its counts fall into, and visits each further
   cell of its own length (later ones only) and of the next length whose box one edit reaches.
3. A task builds the k-d tree of a cell's words down to leaves of ``LEAF`` words and searches it for all words of the
   cell and all visitors, in blocks: boxes that one edit cannot reach are pruned, the words of the other leaves are
   compared by their counts, and those that fit by the order of their letters.
4. A task returns sums: of each word, how many near words it met and which of them is the most frequent. No pairs leave it.
5. Words point to their forms; pointers are followed to their ends by doubling.

Every pair of near words meets in exactly one cell. The sample decides only how evenly words are cut into cells.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import texts as X
from newsloom.session import stored

# Words of a cell, about: what one task indexes.
CELL = 1 << 15
# Words of the sample that one cell is worth, and of any sample at least.
SAMPLE_PER_CELL, LEAST_SAMPLE = 16, 1 << 12
LEAF = 12
# Letters a-z have a dimension each; all other letters share six.
DIMENSIONS = 32
# Cells of a matrix that a task fills at a time.
MATRIX = 1 << 20

_LETTERS = "[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_AXIS = np.empty(256, np.int64)
_AXIS[:] = 26 + np.arange(256) % (DIMENSIONS - 26)
_AXIS[97:123] = np.arange(26)


def count_words(docs: DataFrame, id_column: str, text: str, letters: int, least: int, every: int) -> DataFrame:
    """Rows (word, n): words that occur at least ``least`` times. Equal words of a task are summed before the shuffle."""
    doc_id = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
    runs = F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(f"({_LETTERS}{{{letters},}})"), F.lit(1))
    rows = docs.select(doc_id.alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = rows.select(F.when(h % every == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row of letter counts for each word, given as Latin-1 bytes."""
    out = np.zeros(len(words) * DIMENSIONS, np.int32)
    data = np.frombuffer(b"".join(words), np.uint8)
    if len(data):
        row = np.repeat(np.arange(len(words)), [len(w) for w in words])
        out += np.bincount(row * DIMENSIONS + _AXIS[data], minlength=len(out)).astype(np.int32)
    return out.reshape(len(words), DIMENSIONS)


@dataclass
class Tree:
    """A k-d tree: of each inner node the axis and the greatest count on its left; children; boxes of all nodes."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: list[np.ndarray]
    leaf: np.ndarray  # number of each leaf, -1 for inner nodes


def _split(points: np.ndarray) -> tuple[int, int] | None:
    """The axis and cut that part points most evenly; None if all are equal."""
    best, half = None, len(points)
    for axis in np.flatnonzero(points.min(axis=0) < points.max(axis=0)):
        values = np.sort(points[:, axis])
        middle = values[(len(values) - 1) // 2]
        for cut in {int(middle), int(middle) - 1}:
            n = int(np.searchsorted(values, cut, "right"))
            if 0 < n < len(values) and abs(len(values) - 2 * n) < half:
                best, half = (int(axis), cut), abs(len(values) - 2 * n)
    return best


def build(points: np.ndarray, leaf: int, whole_space: bool = False) -> Tree:
    """A tree whose leaves hold at most ``leaf`` points, or equal ones.

    Boxes are those of the points; with ``whole_space``, those of all that the cuts leave, so they hold any point.
    """
    axis, cut, left, right, low, high, rows, number = [], [], [], [], [], [], [], []
    leaves: list[np.ndarray] = []

    def add(mine: np.ndarray, a: np.ndarray, b: np.ndarray) -> int:
        if not whole_space and len(mine):
            a, b = points[mine].min(axis=0), points[mine].max(axis=0)
        for column, value in ((axis, -1), (cut, 0), (left, -1), (right, -1), (low, a), (high, b), (rows, mine), (number, -1)):
            column.append(value)
        return len(axis) - 1

    start = np.full(points.shape[1], -1, np.int32), np.full(points.shape[1], np.iinfo(np.int32).max, np.int32)
    open_ = [add(np.arange(len(points)), *start)]
    while open_:
        node = open_.pop()
        mine = rows[node]
        found = _split(points[mine]) if len(mine) > leaf else None
        if found is None:
            number[node] = len(leaves)
            leaves.append(mine)
        else:
            axis[node], cut[node] = found
            below = points[mine, found[0]] <= found[1]
            a, b = high[node].copy(), low[node].copy()
            a[found[0]], b[found[0]] = found[1], found[1] + 1
            left[node], right[node] = add(mine[below], low[node], a), add(mine[~below], b, high[node])
            open_ += [right[node], left[node]]
        rows[node] = None
    shape = (len(axis), points.shape[1])
    return Tree(
        np.array(axis), np.array(cut), np.array(left), np.array(right),
        np.array(low, np.int32).reshape(shape), np.array(high, np.int32).reshape(shape), leaves, np.array(number),
    )


def home(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The number of the leaf that each point falls into."""
    node = np.zeros(len(points), np.int64)
    while (inner := np.flatnonzero(tree.axis[node] >= 0)).size:
        at = node[inner]
        below = points[inner, tree.axis[at]] <= tree.cut[at]
        node[inner] = np.where(below, tree.left[at], tree.right[at])
    return tree.leaf[node]


def reached(tree: Tree, low: np.ndarray, high: np.ndarray, more: int) -> tuple[np.ndarray, np.ndarray]:
    """Which leaves an edit may reach from boxes (a point is a box): pairs of a box's row and a leaf's number.

    ``more`` is 1 if the words of the leaves have one letter more: then one count goes up. Otherwise one goes up and
    one goes down.
    """
    box, node, found = np.arange(len(low)), np.zeros(len(low), np.int64), []
    while len(box):
        go_on = []
        for part in np.array_split(np.arange(len(box)), -(-len(box) * low.shape[1] // MATRIX)):
            b, n = box[part], node[part]
            up = np.maximum(tree.low[n] - high[b], 0).sum(axis=1)
            down = np.maximum(low[b] - tree.high[n], 0).sum(axis=1)
            go_on.append(part[(up <= 1) & (down <= 1 - more)])
        go_on = np.concatenate(go_on)
        box, node = box[go_on], node[go_on]
        done = tree.axis[node] < 0
        found.append((box[done], tree.leaf[node[done]]))
        box, node = np.repeat(box[~done], 2), np.stack((tree.left[node[~done]], tree.right[node[~done]]), axis=1).ravel()
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))


def _bits(counts: np.ndarray) -> np.ndarray:
    """Counts as bits, one for each letter up to four of a kind: differing bits never exceed differing letters."""
    filled = (np.minimum(counts, 4)[:, :, None] > np.arange(4)).reshape(len(counts), DIMENSIONS * 4)
    return np.ascontiguousarray(np.packbits(filled, axis=1).view(np.uint64).T)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words, rows of letters, differ by one replaced letter, or by one inserted if ``b`` has one more."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    same = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    return same + np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1) >= n


def _padded(rows: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows))), -1, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def near_pairs(points: np.ndarray, letters: np.ndarray, tree: Tree, queries: np.ndarray, query_letters: np.ndarray, same: bool):
    """Yield arrays (query, word) of near pairs. With ``same``, queries are the tree's own words, and each pair comes once."""
    if not len(points) or not len(queries):
        return
    more = letters.shape[1] - query_letters.shape[1]
    leaves = [part for rows in tree.rows for part in np.array_split(rows, -(-len(rows) // LEAF))]
    of_leaf = np.repeat(np.arange(len(tree.rows)), [-(-len(rows) // LEAF) for rows in tree.rows])
    if same:
        blocks = leaves
    else:
        order = np.argsort(home(tree, queries), kind="stable")
        where = home(tree, queries)[order]
        cuts = np.flatnonzero(np.diff(where)) + 1
        blocks = [part for rows in np.split(order, cuts) for part in np.array_split(rows, -(-len(rows) // LEAF))]
    low = np.array([queries[b].min(axis=0) for b in blocks])
    high = np.array([queries[b].max(axis=0) for b in blocks])
    block, leaf = reached(tree, low, high, more)
    # A leaf of more than LEAF equal points has several parts.
    first, parts = np.searchsorted(of_leaf, leaf), np.bincount(of_leaf, minlength=len(tree.rows))[leaf]
    block = np.repeat(block, parts)
    part = np.repeat(first, parts) + np.arange(len(block)) - np.repeat(np.cumsum(parts) - parts, parts)
    if same:
        block, part = block[block <= part], part[block <= part]
    ours, theirs = _padded(blocks), _padded(leaves)
    q_bits, p_bits = _bits(queries), _bits(points)
    step = max(1, MATRIX // (ours.shape[1] * theirs.shape[1]))
    for at in range(0, len(block), step):
        q, p = ours[block[at : at + step]], theirs[part[at : at + step]]
        differ = sum(np.bitwise_count(mine[q][:, :, None] ^ other[p][:, None, :]) for mine, other in zip(q_bits, p_bits, strict=True))
        i, x, y = np.nonzero(differ <= 2 - more)
        q, p = q[i, x], p[i, y]
        fits = (q >= 0) & (p >= 0)
        if same:
            fits &= (block[at + i] < part[at + i]) | (x < y)
        q, p = q[fits], p[fits]
        for some in np.array_split(np.arange(len(q)), max(1, len(q) * letters.shape[1] // MATRIX)):
            good = some[one_edit(query_letters[q[some]], letters[p[some]])]
            if len(good):
                yield q[good], p[good]


def _latin(words: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in words.to_pylist()]


def _letters(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


class _Best:
    """Of the words of a cell, how many near ones each has and which is the most frequent (ties: the smallest)."""

    def __init__(self, n: np.ndarray, words: list[bytes]) -> None:
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        self.value = np.empty(len(words), np.int64)  # places in the order by frequency, then by word: larger is better
        self.order = np.lexsort((-rank, n))
        self.value[self.order] = np.arange(len(words))
        self.count, self.best = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in ((a, b), (b, a)):
            self.count += np.bincount(x, minlength=len(self.count))
            np.maximum.at(self.best, x, self.value[y])


def _search_cell(cell: pa.Table) -> pa.Table:
    """Near words within one cell: of its own words, and of visitors of the same and of the shorter length with them."""
    words, n, role = _latin(cell["word"].combine_chunks()), cell["n"].to_numpy(), cell["role"].to_numpy()
    own, same, less = (np.flatnonzero(role == r) for r in (0, 1, 2))
    best = _Best(n, words)
    if len(own):
        points = letter_counts([words[i] for i in own])
        letters = _letters([words[i] for i in own])
        tree = build(points, LEAF)
        for q, p in near_pairs(points, letters, tree, points, letters, True):
            best.add(own[q], own[p])
        for guests in (same, less):
            if len(guests):
                theirs = [words[i] for i in guests]
                for q, p in near_pairs(points, letters, tree, letter_counts(theirs), _letters(theirs), False):
                    best.add(guests[q], own[p])
    met = np.flatnonzero(best.count)
    chosen = best.order[best.best[met]] if len(met) else met
    return pa.table(
        {
            "word": pa.array([words[i].decode("latin-1") for i in met], pa.string()),
            "n_near": pa.array(best.count[met]),
            "form_n": pa.array(n[chosen].astype(np.int64)),
            "form": pa.array([words[i].decode("latin-1") for i in chosen], pa.string()),
        }
    )


def _cell_trees(words: DataFrame, cell: int) -> tuple[dict[int, Tree], dict[int, int]]:
    """For each length, the upper tree that cuts its words into cells, and the number of its first cell.

    It is built from a sample of the words by hash, ``SAMPLE_PER_CELL`` for each cell that a length needs: about 1 / 2000
    of the words, from lengths of more than ``cell`` words only.
    """
    sizes = {r.length: r.n for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    many = {length: n for length, n in sizes.items() if n > cell}
    sampled: dict[int, list[bytes]] = {length: [] for length in sizes}
    if many:
        share = {length: min(1.0, max(LEAST_SAMPLE, SAMPLE_PER_CELL * (n / cell)) / n) for length, n in many.items()}
        wanted = F.element_at(F.create_map(*[F.lit(x) for pair in share.items() for x in pair]), F.length("word"))
        large = words.where(F.length("word").isin(list(many)))
        drawn = large.where((F.xxhash64("word").cast("double") / 2.0**64 + 0.5) < wanted).select("word")
        for row in drawn.toLocalIterator():
            sampled[len(row.word)].append(row.word.encode("latin-1"))
    trees, first, total = {}, {}, 0
    for length in sorted(sizes):
        points = letter_counts(sampled[length])
        cells = -(-sizes[length] // cell)
        trees[length] = build(points, max(1, len(points) // cells), whole_space=True)
        first[length] = total
        total += len(trees[length].rows)
        trees[length].rows = []
    return trees, first


def _deal(trees, first):
    """Send each word to the cell it lives in and to those it visits."""

    def run(batches):
        trees_, first_ = trees.value, first
        for batch in batches:
            words = _latin(X.column(batch, "word"))
            n = X.longs(batch, "n")
            lengths = np.array([len(w) for w in words], np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                for some in np.array_split(rows, -(-len(rows) // 4096)):
                    points = letter_counts([words[i] for i in some])
                    tree = trees_[length]
                    at = home(tree, points)
                    who, leaf = reached(tree, points, points, 0)
                    later = leaf > at[who]
                    out = [(some, at + first_[length], 0), (some[who[later]], leaf[later] + first_[length], 1)]
                    if length + 1 in trees_:
                        who, leaf = reached(trees_[length + 1], points, points, 1)
                        out.append((some[who], leaf + first_[length + 1], 2))
                    index = np.concatenate([o[0] for o in out])
                    yield pa.record_batch(
                        {
                            "cell": pa.array(np.concatenate([o[1] for o in out]).astype(np.int64)),
                            "role": pa.array(np.repeat([o[2] for o in out], [len(o[0]) for o in out]).astype(np.int8)),
                            "word": X.column(batch, "word").take(pa.array(index)),
                            "n": pa.array(n[index]),
                        }
                    )

    return run


def roots(pointers: DataFrame) -> DataFrame:
    """Rows (word, root) from rows (word, form): forms followed to the last. Chains must not close.

    Each round doubles how far a pointer reaches, so a chain of any length takes its logarithm of rounds.
    """
    now = stored(pointers.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        jumped = stored(jumped, "roots")
        now = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return now


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", letters: int = 7, least: int = 2, ratio: int = 10,
    every: int = 31, cell: int | None = None,
) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one for each word.

    Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts, A-Z lower-cased; of a run whose crc32 of
    ``<id>:<run>`` divides by ``every``, the code point at crc32 modulo length is deleted first. Of those, words of at
    least ``letters`` code points that occur at least ``least`` times (``n``) count. ``n_near`` is how many words differ by
    exactly one inserted, deleted or replaced code point. ``form`` is the near word of largest n, of equal ones the
    smallest in code-point order, if its n (``form_n``) is at least ``ratio`` times the word's; else both are null.
    ``root`` is the last form of the chain of forms, the word itself without a form.

    A null or empty text has no words; a null id reads as an empty one. Rows that repeat count each time, rows that repeat
    an id read their own text. A word of any length is one word. An empty table gives an empty result. Other columns are
    not read.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1: chains of forms would close")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = stored(count_words(docs, id_column, text, letters, least, every), "words")
    trees, first = _cell_trees(words, cell or CELL)
    shared = spark.sparkContext.broadcast(trees)
    dealt = words.mapInArrow(_deal(shared, first), "cell long, role byte, word string, n long")
    met = dealt.repartition(4 * parts, "cell").groupBy("cell").applyInArrow(_search_cell, "word string, n_near long, form_n long, form string")
    # Of equal counts the smallest word is the form, so counts are compared upside down.
    met = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
    found = stored(words.join(met, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "best"), "near")
    chosen = -F.col("best.less") >= ratio * F.col("n")
    named = found.select("word", "n", "n_near", F.when(chosen, F.col("best.form")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"))
    ends = roots(named.where("form is not null"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# The checksum's table follows from its polynomial. Letters are at most U+00FF, so a code point has one or two bytes.
_CRC = [*range(256)]
for _ in range(8):
    _CRC = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in _CRC]
_MORE = "[^A-Za-z\u00c0-\u00ff]+"

VARIANTS_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '{_MORE}')) AS run FROM documents),
lowered AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS head, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS times
  FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, times, xor(list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(flatten(list_transform(string_split(head || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)]
      ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)), lambda b: b::UBIGINT)),
    lambda a, b: xor(a >> 8, ({_CRC}::UBIGINT[])[CAST(1 + xor(a & 255, b) AS BIGINT)])), 4294967295::UBIGINT) AS h FROM lowered),
words AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2)
      ELSE run END AS word, times FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
places AS MATERIALIZED (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
cuts AS MATERIALIZED (SELECT word, i, left(word, i - 1) AS head, substring(word, i + 1) AS tail FROM places),
pairs AS MATERIALIZED (
  SELECT DISTINCT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT a.word, w.word FROM cuts a JOIN words w ON w.word = a.head || a.tail
  UNION SELECT w.word, a.word FROM cuts a JOIN words w ON w.word = a.head || a.tail),
near AS (SELECT a, count(*) AS n_near, max(n) AS best, arg_min(b, (-n, b)) AS form FROM pairs JOIN words ON word = b GROUP BY a),
named AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best >= 10 * n THEN form END AS form,
    CASE WHEN best >= 10 * n THEN best END AS form_n FROM words LEFT JOIN near ON a = word),
chain AS (SELECT word, word AS root, 0 AS step FROM named
  UNION ALL SELECT c.word, m.form, step + 1 FROM chain c JOIN named m ON m.word = c.root WHERE m.form IS NOT NULL)
SELECT word, any_value(form) AS form, arg_max(root, step) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
FROM chain JOIN named USING (word) GROUP BY word"""
