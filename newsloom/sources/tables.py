"""Main tables as committed versions, whole or cut into buckets by a hash of their keys.

A version is one small file, ``commits/<number>.json``: the table's schema and the folders that hold its rows. Folders
are written first, under names of their own, and never change; the commit is put only where no file of that number
is. So readers see whole versions, earlier ones stay as backups, and of two writers that started from the same version
one finds its number taken. It then commits on top of the other's version if their buckets differ, and does its change
again on the newer rows if not.

A batch reads and writes only the buckets that its keys fall in. Buckets double when they have grown to twice the
wanted rows, which rewrites the table once for as many rows as it has gained since.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.merge import SEQ, sorted_layer, upsert
from newsloom.session import stored

# Rows of a bucket, about.
BUCKET_ROWS = 1_000_000
# Rows of a bucket that a task writes, about: larger buckets are dealt out to several tasks.
PART_ROWS = 10_000
# Appended folders of a bucket before its rows are written as one again.
MAX_FOLDERS = 8
# How often a writer starts again before it gives up.
TRIES = 20

_BUCKET, _HASH, _PART = "_bucket", "_hash", "_part"


@dataclass(frozen=True)
class Version:
    """What a commit says: the schema, and by bucket its folders and rows. A whole table is the bucket 0 of none."""

    number: int
    schema: T.StructType
    buckets: int = 0
    folders: dict[int, list[str]] = field(default_factory=dict)
    rows: dict[int, int] = field(default_factory=dict)

    def text(self) -> str:
        body = {"schema": self.schema.jsonValue(), "buckets": self.buckets, "folders": self.folders, "rows": self.rows}
        return json.dumps(body)

    @classmethod
    def of(cls, number: int, text: str) -> Version:
        body = json.loads(text)
        by_bucket = [{int(k): v for k, v in body[name].items()} for name in ("folders", "rows")]
        return cls(number, T.StructType.fromJson(body["schema"]), body["buckets"], *by_bucket)


@dataclass(frozen=True)
class Commit:
    """The version that a change led to, and how many buckets it read and wrote."""

    number: int
    buckets_read: int
    buckets_written: int


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; whoever sees it sees all of it.

    It is written under another name first. A local file then gets its name by a link and any other by a rename that
    must not replace, both of which fail where the name is taken.
    """
    fs, target = _hadoop_path(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            paths = spark._jvm.java.nio.file.Paths
            of = [paths.get(spark._jvm.java.net.URI.create(f"file://{p.toUri().getRawPath()}")) for p in (target, draft)]
            spark._jvm.java.nio.file.Files.createLink(*of)
        else:
            options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)
    except Py4JJavaError as error:
        if not error.java_exception.getClass().getSimpleName().startswith("FileAlreadyExists"):
            raise
        return False
    finally:
        fs.delete(draft, False)
    return True


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all versions of a table, oldest first."""
    fs, folder = _hadoop_path(spark, f"{path}/commits")
    if not fs.exists(folder):
        return []
    names = [re.fullmatch(r"(\d+)\.json", s.getPath().getName()) for s in fs.listStatus(folder)]
    return sorted(int(m[1]) for m in names if m)


def _commit_file(path: str, number: int) -> str:
    return f"{path}/commits/{number:08d}.json"


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version, by default the newest; None if the table has none."""
    if number is None:
        found = versions(spark, path)
        if not found:
            return None
        number = found[-1]
    fs, file = _hadoop_path(spark, _commit_file(path, number))
    stream = fs.open(file)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return Version.of(number, text)


def commit(spark: SparkSession, path: str, new: Version) -> bool:
    """Make ``new`` a version of the table unless its number is taken."""
    return put_if_absent(spark, _commit_file(path, new.number), new.text())


def rows_of(spark: SparkSession, path: str, of: Version, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets. No other folders are read."""
    chosen = of.folders if buckets is None else [b for b in buckets if b in of.folders]
    folders = [f"{path}/{folder}" for b in chosen for folder in of.folders[b]]
    if not folders:
        return spark.createDataFrame([], of.schema)
    return spark.read.schema(of.schema).parquet(*folders)


def read_snapshot(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The newest version of a table, or the one of a number; None if there is none."""
    found = version(spark, path, number)
    return None if found is None else rows_of(spark, path, found)


def snapshots(spark: SparkSession, path: str) -> list[str]:
    """The commit files of a table, oldest first. All but the last one are its backups."""
    return [_commit_file(path, number) for number in versions(spark, path)]


def write_snapshot(df: DataFrame, path: str, order: Sequence[str] = ("datetime",)) -> str:
    """Write a whole table as the next version, sorted; earlier ones, which ``df`` may read from, stay as they are.

    It replaces whatever version there is when it is done. For a change of the rows that are there, see
    ``update_snapshot``.
    """
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    sorted_layer(stored(df, "snapshot"), *order).write.parquet(f"{path}/{folder}")
    new = Version(0, _plain(df.schema), 0, {0: [folder]}, {})
    while True:
        number = max(versions(spark, path), default=0) + 1
        if commit(spark, path, replace(new, number=number)):
            return f"{path}/{folder}"


def update_snapshot(
    spark: SparkSession, path: str, change: Callable[[DataFrame | None], DataFrame], order: Sequence[str] = ("datetime",)
) -> int:
    """Write ``change`` of the newest version as the next one, and return its number.

    If another writer was faster, the change is made again on what that one wrote, so no version is lost.
    """
    for _ in range(TRIES):
        old = version(spark, path)
        df = change(None if old is None else rows_of(spark, path, old))
        folder = f"data/{uuid.uuid4().hex}"
        sorted_layer(stored(df, "snapshot"), *order).write.parquet(f"{path}/{folder}")
        number = old.number + 1 if old else 1
        if commit(spark, path, Version(number, _plain(df.schema), 0, {0: [folder]}, {})):
            return number
    raise RuntimeError(f"{path}: other writers were faster {TRIES} times")


def _plain(schema: T.StructType) -> T.StructType:
    """The schema as files give it back: everything may be null, no metadata."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _buckets_for(rows: int, bucket_rows: int) -> int:
    n = 1
    while n * bucket_rows < rows:
        n *= 2
    return n


def _write_buckets(df: DataFrame, path: str, n: int, hash_of: Column, bucket_rows: int, order: Sequence[str]) -> tuple[dict[int, str], dict[int, int]]:
    """Write rows by bucket, sorted within each file; the folder and number of rows of each bucket.

    Tasks are those of any shuffle, so there are no more of them for more buckets. A task writes a file for each bucket
    that it has rows of. Buckets of ``bucket_rows`` rows beyond ``PART_ROWS`` are dealt out to several tasks.
    """
    folder, spark = f"data/{uuid.uuid4().hex}", df.sparkSession
    # Buckets go by the low bits of the hash, parts by the high ones.
    part = F.pmod(F.shiftrightunsigned(hash_of, 32), F.lit(max(1, -(-bucket_rows // PART_ROWS))))
    dealt = df.withColumns({_BUCKET: F.pmod(hash_of, F.lit(n)).cast("int"), _PART: part.cast("int")}).repartition(_BUCKET, _PART).drop(_PART)
    dealt.sortWithinPartitions(_BUCKET, *[c for c in order if c in df.columns]).write.partitionBy(_BUCKET).parquet(f"{path}/{folder}")
    written = spark.read.schema(T.StructType([T.StructField(_BUCKET, T.IntegerType())])).parquet(f"{path}/{folder}")
    counted = {r[_BUCKET]: r["count"] for r in written.groupBy(_BUCKET).count().collect()}
    return {b: f"{folder}/{_BUCKET}={b}" for b in counted}, counted


def _normal(schema: T.StructType) -> list[Column]:
    """All columns, for a hash that is the same for equal rows: there are two zeros."""
    floating = (T.DoubleType, T.FloatType)
    return [F.when(F.col(f.name) != 0, F.col(f.name)).otherwise(F.col(f.name) * 0) if isinstance(f.dataType, floating) else F.col(f.name) for f in schema.fields]


def _change_buckets(
    batch: DataFrame, path: str, hash_of: Callable[[T.StructType], Column], merge: Callable[[DataFrame, DataFrame | None], DataFrame],
    order: Sequence[str], bucket_rows: int, append: bool,
) -> Commit:
    """Put ``merge`` of the batch and the rows of its buckets in place of these rows, or, with ``append``, beside them."""
    spark = batch.sparkSession
    batch = stored(batch.withColumn(_HASH, hash_of(batch.schema)), "batch")
    plain = batch.drop(_HASH)
    size = batch.count()
    for _ in range(TRIES):
        old = version(spark, path)
        known = sum(old.rows.values()) if old else 0
        n = old.buckets if old else 0
        whole = not n or known > 2 * n * bucket_rows  # no buckets yet, or too large ones: all rows are dealt out anew
        if whole:
            n = max(n, _buckets_for(max(known, size), bucket_rows))
            if old and not old.buckets:
                n = max(n, _buckets_for(rows_of(spark, path, old).count() + size, bucket_rows))
            touched = list(range(n))
            rows = rows_of(spark, path, old) if old else None
        else:
            touched = [r[0] for r in batch.select(F.pmod(_HASH, F.lit(n)).cast("int")).distinct().collect()]
            rows = rows_of(spark, path, old, touched)
        if append and not whole and all(len(old.folders.get(b, ())) < MAX_FOLDERS for b in touched):
            new, keep = merge(plain, rows), {b: old.folders.get(b, []) for b in touched}
        elif append:
            new, keep = (plain if rows is None else rows.unionByName(plain.select(rows.columns))).distinct(), {}
        else:
            new, keep = merge(plain, rows), {}
        there = sum(old.rows.get(b, 0) for b in touched) if old and old.buckets else known
        folders, counted = _write_buckets(new, path, n, hash_of(_plain(new.schema)), (size + there) // max(1, len(touched)), order)
        if append and not counted and old and not whole:
            return Commit(old.number, len(touched), 0)
        changed = {b: keep.get(b, []) + ([folders[b]] if b in folders else []) for b in touched}
        rows_now = {b: counted.get(b, 0) + (old.rows.get(b, 0) if keep.get(b) else 0) for b in touched}
        schema = old.schema if old and old.buckets else _plain(new.schema)
        base = old
        while True:
            rest = {} if whole or base is None else base.folders
            rest_rows = {} if whole or base is None else base.rows
            number = base.number + 1 if base else 1
            next_ = Version(
                number, schema, n, {b: f for b, f in {**rest, **changed}.items() if f}, {b: r for b, r in {**rest_rows, **rows_now}.items() if r}
            )
            if commit(spark, path, next_):
                return Commit(number, 0 if old is None else len(touched), len(folders))
            # Another writer was faster. If it left these buckets as they were, this change holds on its version too.
            base = version(spark, path)
            if whole or base.buckets != n or old is None or any(base.folders.get(b) != old.folders.get(b) for b in touched):
                break
    raise RuntimeError(f"{path}: other writers were faster {TRIES} times")


def upsert_main(
    batch: DataFrame, path: str, key: str = "url", terms: str = "search_terms", order: Sequence[str] = ("datetime",),
    bucket_rows: int = BUCKET_ROWS,
) -> Commit:
    """Put a batch over a main table: batch rows win over main rows of their key, terms are united.

    Only the buckets that the batch's keys fall in are read and written. Rows without a key are dropped. A table that
    was written whole before gets buckets now. An empty batch changes nothing but the number.
    """

    def merge(rows: DataFrame, main: DataFrame | None) -> DataFrame:
        return upsert(rows, main, key, terms, main_is_unique=True).drop(SEQ)

    return _change_buckets(batch.where(F.col(key).isNotNull()), path, lambda _: F.xxhash64(key), merge, (*order, key), bucket_rows, False)


def append_main(new: DataFrame, path: str, order: Sequence[str] = ("datetime",), bucket_rows: int = BUCKET_ROWS) -> Commit:
    """Add the rows of ``new`` that a main table does not have yet, each once.

    Rows fall into buckets by all their columns, so equal rows meet and no key makes a bucket large. Of the buckets that
    they fall in, rows are read but not written again, except once every ``MAX_FOLDERS`` appends.
    """

    def merge(rows: DataFrame, main: DataFrame | None) -> DataFrame:
        return rows.distinct() if main is None else rows.subtract(main.select(rows.columns))

    return _change_buckets(new, path, lambda schema: F.xxhash64(*_normal(schema)), merge, order, bucket_rows, True)
