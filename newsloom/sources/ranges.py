"""Records of CSV files read by many tasks per file, quoted line breaks included; and CSV members of zip archives.

Whether a line break ends a record depends on all quotes before it. So a file is read twice, by the ranges that Spark cuts
it into. First, each range says in what state it ends, inside or outside a quoted field, if it starts outside and if it
starts inside. Chaining these answers from the file's start gives the true state at each range's start. Then each range
reads the records that lie in it whole; the pieces of records that run over range ends are put together by a grouping.
A quoted field longer than a range runs through several ranges and is put together the same way.
"""

from __future__ import annotations

import csv
import io
import itertools
import re
import sys
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.session import stored

# Larger archives are not opened: an archive is one cell of a binary scan.
MAX_ARCHIVE = (1 << 31) - (1 << 20)
# Rows of a batch that a task hands on.
BATCH = 2000

_CLOSE = re.compile(r'(?:[^"]|"")*+"')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line. A quote opens a field only at the field's start."""
    if not inside and not line.startswith('"') and ',"' not in line:
        return False
    at = 0
    while True:
        if inside or line.startswith('"', at):
            closed = _CLOSE.match(line, at if inside else at + 1)
            if not closed:
                return True
            at, inside = closed.end(), False
        at = line.find(",", at) + 1
        if not at:
            return False


def bare(record: str) -> str:
    """A record without its line end. Where lines end in two characters, breaks within it become one, as in Spark's reader."""
    return record[:-1].replace("\r\n", "\n") if record.endswith("\r") else record


def fields(record: str) -> list[str]:
    """The fields of one record without its line end."""
    try:
        return next(csv.reader([record]), [])
    except csv.Error:  # a bare carriage return, or an odd quote
        out, at = [], 0
        while True:
            if record.startswith('"', at) and (closed := _CLOSE.match(record, at + 1)):
                end = record.find(",", closed.end())
                end = len(record) if end < 0 else end
                out.append(record[at + 1 : closed.end() - 1].replace('""', '"') + record[closed.end() : end])
            else:
                end = record.find(",", at)
                end = len(record) if end < 0 else end
                out.append(record[at:end])
            if end == len(record):
                return out
            at = end + 1


def _lines(spark: SparkSession, paths: Sequence[str], included: Callable[[Column], Column], **options: str) -> DataFrame:
    """Rows (path, start, value): lines as they come, with the file and range that they are in.

    ``included`` chooses files by name; others are not opened.
    """
    reader = spark.read.option("lineSep", "\n").options(**options)
    return reader.text(list(paths)).where(included(F.col("_metadata.file_name"))).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """Runs of lines of one range, in order; a range may come in several runs."""
    for batch in batches:
        paths, starts = batch.column(0), batch.column(1).to_pylist()
        values, at = batch.column(2).to_pylist(), 0
        while at < len(values):
            path, end = paths[at].as_py(), at + 1
            while end < len(values) and starts[end] == starts[at] and paths[end].as_py() == path:
                end += 1
            yield (path, starts[at]), values[at:end]
            at = end


class _Assumed:
    """A range read under the assumption that it starts inside or outside a quoted field."""

    def __init__(self, inside: bool) -> None:
        self.inside, self.head_done = inside, not inside
        self.head: list[str] = []
        self.tail: list[str] = []
        self.first: str | None = None

    def add(self, line: str) -> None:
        part = self.tail if self.head_done else self.head
        part.append(line)
        self.inside = ends_inside(line, self.inside)
        if self.inside:
            return
        if not self.head_done:
            self.head_done = True
            return
        if self.first is None and any(x.strip("\r") for x in part):
            self.first = "\n".join(part)
        self.tail = []


_SURVEY = "path string, start long, end_out boolean, end_in boolean, tail_out string, head_in string, tail_in string, head_closed boolean, first string"


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range, how it ends under either assumption, and its pieces of records that run over its ends."""

    def row(key, out, in_):
        tail = "\n".join(in_.tail) if in_.head_done and in_.inside else None
        return (*key, out.inside, in_.inside, "\n".join(out.tail) if out.inside else None, "\n".join(in_.head), tail, in_.head_done, out.first)

    last, rows, both = None, [], ()
    for key, lines in _by_range(batches):
        if key != last:
            if last:
                rows.append(row(last, *both))
            last, both = key, (_Assumed(False), _Assumed(True))
        for line in lines:
            for assumed in both:
                assumed.add(line)
    if last:
        rows.append(row(last, *both))
    names = [part.split()[0] for part in _SURVEY.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    yield pa.record_batch({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)})


def _chain(file: pa.Table) -> pa.Table:
    """Over the ranges of one file in order: whether each starts inside a field, and the range that the open record began in."""
    file = file.sort_by("start")
    inside, opener, states, openers = False, None, [], []
    for start, end_out, end_in, closed in zip(*(file[c].to_pylist() for c in ("start", "end_out", "end_in", "head_closed")), strict=True):
        states.append(inside)
        openers.append(opener)
        if not inside:
            inside, opener = end_out, (start if end_out else None)
        elif closed:
            inside, opener = end_in, (start if end_in else None)
    return pa.table({"path": file["path"], "start": file["start"], "inside": pa.array(states, pa.bool_()), "opener": pa.array(openers, pa.int64())})


def _bare(record: Column) -> Column:
    return F.when(record.endswith("\r"), F.replace(F.regexp_replace(record, r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(record)


class CsvFiles:
    """The records of CSV files: ``headers`` (path, header) and ``records`` (path, record), one row per record.

    ``included`` chooses files by name. The first record of a file is its header and no record; blank lines are none
    either. Files are UTF-8, quoted by ``"`` with doubled quotes inside. Where a file's codec cannot be split, the file is
    one range. Files without any bytes are not seen, as Spark does not list them.
    """

    def __init__(
        self, spark: SparkSession, paths: Sequence[str], included: Callable[[Column], Column] = lambda name: F.lit(True), **options: str
    ) -> None:
        lines = _lines(spark, paths, included, **options)
        survey = stored(lines.mapInArrow(_survey, _SURVEY), "ranges")
        narrow = survey.select("path", "start", "end_out", "end_in", "head_closed")
        states = stored(narrow.groupBy("path").applyInArrow(_chain, "path string, start long, inside boolean, opener long"), "states")
        # One entry for each range that starts inside a quoted field; ranges are of the size that Spark splits files by.
        open_ = spark.sparkContext.broadcast({(r.path, r.start) for r in states.where("inside").select("path", "start").toLocalIterator()})

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, skip, inside, part, found = None, False, False, [], ([], [])
            for key, lines_ in _by_range(batches):
                if key != last:
                    last, inside, part = key, key in open_.value, []
                    skip, header = inside, key[1] == 0
                for line in lines_:
                    part.append(line)
                    inside = ends_inside(line, inside)
                    if inside:
                        continue
                    record, part = "\n".join(part), []
                    if skip:
                        skip = False
                    elif record.strip("\r\n"):
                        if header:
                            header = False
                        else:
                            found[0].append(key[0])
                            found[1].append(bare(record))
                if len(found[0]) >= BATCH:
                    yield pa.record_batch({"path": pa.array(found[0], pa.string()), "record": pa.array(found[1], pa.string())})
                    found = ([], [])
            yield pa.record_batch({"path": pa.array(found[0], pa.string()), "record": pa.array(found[1], pa.string())})

        known = survey.join(states, ["path", "start"])
        pieces = known.where("inside").select("path", F.col("opener").alias("id"), F.col("start").alias("at"), F.col("head_in").alias("text"))
        tails = known.select("path", F.col("start").alias("id"), F.col("start").alias("at"), F.when(F.col("inside"), F.col("tail_in")).otherwise(F.col("tail_out")).alias("text"))
        pieces = pieces.union(tails.where("text is not null"))
        ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n")
        over_ends = pieces.groupBy("path", "id").agg(ordered.alias("record"))
        # A file's first record is its header, also if it runs over the end of the first range.
        begins = survey.where("start = 0").select("path", "first", F.lit(0).cast("long").alias("id"))
        over_ends = over_ends.join(begins, ["path", "id"], "left").withColumn("header", F.col("id").eqNullSafe(F.lit(0)) & F.col("first").isNull())
        over_ends = stored(over_ends.select("path", _bare(F.col("record")).alias("record"), "header"), "over")
        first = begins.where("first is not null").select("path", _bare(F.col("first")).alias("header"))
        self.headers = first.union(over_ends.where("header").select("path", F.col("record").alias("header")))
        self.records = lines.mapInArrow(whole, "path string, record string").union(over_ends.where("not header").select("path", "record"))


def split_fields(record: Column) -> Column:
    """The fields of records, as an array."""

    def run(records: pa.Array) -> pa.Array:
        csv.field_size_limit(sys.maxsize)
        return pa.array([None if r is None else fields(r) for r in records.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(run, T.ArrayType(T.StringType()))(record)


# Members of zip archives


def _members(content: bytes) -> Iterator[list[str]]:
    """The records of the only member of an archive, one after the other; blank ones are left out."""
    csv.field_size_limit(sys.maxsize)
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        members = [m for m in archive.infolist() if not m.is_dir()]
        if len(members) != 1:
            raise ValueError(f"{len(members)} members in the archive")
        with archive.open(members[0]) as raw, io.TextIOWrapper(raw, "utf-8-sig", newline="") as text:
            first = text.readline()
            two = first.endswith("\r\n")
            for record in csv.reader(itertools.chain([first], text)):
                if record:
                    yield [value.replace("\r\n", "\n") for value in record] if two else record


_BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, ValueError, RuntimeError, NotImplementedError, csv.Error)


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv.zip")
    return reader.load(folder)


def zip_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (path, names, error), one for each zip archive: the names in its header, or why it is not read.

    An archive must hold one member. Only the member's first record is unpacked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, errors = [], []
            for content in batch.column("content"):
                try:
                    names.append(next(_members(content.as_buffer().to_pybytes())))
                    errors.append(None)
                except StopIteration:
                    names.append(None)
                    errors.append("the member is empty")
                except _BROKEN as error:
                    names.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            yield pa.record_batch({"path": batch.column("path"), "names": pa.array(names, pa.list_(pa.string())), "error": pa.array(errors, pa.string())})

    kind = "path string, names array<string>, error string"
    found = _archives(spark, folder)
    opened = found.where(F.col("length") <= MAX_ARCHIVE).select("path", "content").mapInArrow(run, kind)
    large = found.where(F.col("length") > MAX_ARCHIVE).select("path", F.lit(None).cast("array<string>"), F.lit(f"archive of more than {MAX_ARCHIVE} bytes"))
    return opened.union(large)


def zip_records(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """Rows (path, values, error): the records of all zip archives, with the values of ``columns`` in their order.

    Members are unpacked as they are read, in batches. An archive that breaks off gives the records before, then a row
    with the error and no values.
    """
    columns = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(path, rows, error=None):
            n = len(rows) + (error is not None)
            values = pa.array(rows + ([None] if error else []), pa.list_(pa.string()))
            return pa.record_batch({"path": pa.array([path] * n, pa.string()), "values": values, "error": pa.array([None] * len(rows) + ([error] if error else []), pa.string())})

        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows: list[list] = []
                try:
                    records = _members(content.as_buffer().to_pybytes())
                    names = next(records, [])
                    at = [names.index(c) if c in names else None for c in columns]
                    for record in records:
                        rows.append([record[i] if i is not None and i < len(record) else None for i in at])
                        if len(rows) >= BATCH:
                            yield batch_of(path, rows)
                            rows = []
                    yield batch_of(path, rows)
                except _BROKEN as error:
                    yield batch_of(path, rows, f"{type(error).__name__}: {error}")

    found = _archives(spark, folder).where(F.col("length") <= MAX_ARCHIVE)
    return found.select("path", "content").mapInArrow(run, "path string, values array<string>, error string")
