"""CSV exchange files and Parquet layers; snapshot tables are in ``tables``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.parse import parse_ts
from newsloom.operators.merge import sorted_layer
from newsloom.operators.profile import schema_profile, version_span
from newsloom.operators.validate import require_columns, require_rows
from newsloom.session import stored
from newsloom.sources.ranges import CsvFiles, split_fields, zip_headers, zip_records
from newsloom.sources.tables import read_snapshot, snapshots, write_snapshot  # noqa: F401

_CSV = {
    "header": "true", "multiLine": "true", "escape": '"', "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
_FILES = "*.{csv,csv.gz,csv.bz2}"
# Files beyond this many bytes are read by ranges, where their codec can be split.
LARGE_FILE = 256 << 20


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], strict: bool = False, by_ranges: bool | None = None
) -> DataFrame:
    """CSV (plain, gzip or bzip2) as text columns, with nothing between commas or quotes as null.

    ``datetime`` is parsed, bad values to null unless ``strict``. CSV cannot hold lists, so list
    columns come back as text. As values may hold line breaks, Spark's reader takes a file as one task; files of more
    than ``LARGE_FILE`` bytes are read by many tasks (``by_ranges``; by default their sizes decide).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if by_ranges is None:
        largest = spark.read.format("binaryFile").load(paths).where(~F.col("path").endswith(".gz")).agg(F.max("length")).first()[0]
        by_ranges = (largest or 0) > LARGE_FILE
    if by_ranges:
        kind = ", ".join(f"`{c}` string" for c in columns)
        options = {k: v for k, v in _CSV.items() if k not in ("header", "encoding")}
        df = CsvFiles(spark, paths).records.select(F.from_csv("record", kind, options).alias("r")).select("r.*")
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        df = spark.read.options(**_CSV).schema(schema).csv(paths)
    df = df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])
    if "datetime" in columns:
        df = df.withColumn("datetime", parse_ts(F.col("datetime"), strict))
    return df


def _csv_text(df: DataFrame) -> list[Column]:
    nested = (T.ArrayType, T.MapType, T.StructType)
    return [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ]


def write_csv(
    df: DataFrame,
    path: str,
    compress: bool = False,
    versioned: bool = False,
    expected_columns: Sequence[str] | None = None,
    schema_format: str | None = None,
) -> str:
    """Write a folder of CSV parts and return its path. Lists are written as JSON.

    ``versioned`` adds the earliest and latest ``datetime`` to the name; ``schema_format`` also
    writes the schema profile next to it. ``df`` is computed once, into a scratch table.
    """
    df = stored(require_columns(df, expected_columns or []), "csv")
    require_rows(df, path)
    if versioned:
        span = version_span(df).first()
        path = f"{path}_{span['first']}_{span['last']}"
    writer = df.select(*_csv_text(df)).write.mode("errorifexists").options(**_CSV)
    writer.option("maxRecordsPerFile", 0).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(
        path, compression="gzip" if compress else "none"
    )
    if schema_format:
        write_schema(df, path, schema_format)
    return path


def write_schema(df: DataFrame, path: str, schema_format: str = "yaml", sample_size: int = 2, normalize_types: bool = True) -> str:
    """Write the schema profile of a table as YAML or JSON lines: one entry per column."""
    target = f"{path}.schema.{schema_format}"
    examples = F.array(*[F.col(f"example_{n + 1}") for n in range(sample_size)]).cast("array<string>")
    profile = schema_profile(df, sample_size=sample_size, normalize_types=normalize_types).orderBy("position")
    columns = profile.select("name", "type", "nullable", F.filter(examples, lambda x: x.isNotNull()).alias("examples"))
    if schema_format == "json":
        columns.coalesce(1).write.json(target)
    elif schema_format == "yaml":
        # A JSON object is a YAML flow mapping.
        entry = F.concat(F.lit("- "), F.to_json(F.struct(*columns.columns)))
        columns.select(entry.alias("value")).coalesce(1).write.text(target)
    else:
        raise ValueError(f"unknown format {schema_format}")
    return target


def _listing(spark: SparkSession, folder: str, exclude: str | None) -> DataFrame:
    """Files of a folder that are CSV by name, with their compression."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    kind = F.regexp_extract(name, r"\.csv(?:\.(gz|bz2|zip))?$", 1)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{csv,csv.gz,csv.bz2,csv.zip}")
        .load(folder)
        .select("path", name.alias("file"), kind.alias("kind"))
    )
    files = files.withColumn(
        "compression", F.when(F.col("kind") == "", "uncompressed").otherwise(F.concat(F.lit("."), "kind"))
    ).drop("kind")
    return files.where(_included(F.col("file"), exclude))


def _included(file: Column, exclude: str | None) -> Column:
    """Whether a file's name, without what follows its last dot, is free of ``exclude``."""
    return ~F.regexp_replace(file, r"\.[^.]*$", "").contains(exclude) if exclude else F.lit(True)


def _readable(spark: SparkSession, folder: str) -> DataFrame:
    """Every file that is no archive and has a readable line."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", "true")
        .option("pathGlobFilter", _FILES)
        .text(folder)
        .where("_metadata.file_block_start = 0")
        .select(F.col("_metadata.file_path").alias("path"))
    )
    return lines.distinct()


def folder_scan(
    spark: SparkSession,
    folder: str,
    common_columns: Sequence[str] | None = None,
    exclude: str | None = None,
) -> DataFrame:
    """Union of all CSV files of a folder, plain, gzip, bzip2 or zip, which may have different columns.

    All files are read by the same scans, however many headers there are; each record finds its columns by its file's
    header. Of ``common_columns``, those that some file has come back; without, all columns do. Unreadable files are
    skipped; no file at all gives an empty table.
    """
    options = {"recursiveFileLookup": "true", "ignoreCorruptFiles": "true", "pathGlobFilter": _FILES}
    files = CsvFiles(spark, [folder], included=lambda name: _included(name, exclude), **options)
    plain = files.headers.select("path", split_fields(F.regexp_replace("header", "^\ufeff", "")).alias("names"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    zipped = zip_headers(spark, folder).where(F.col("names").isNotNull() & _included(name, exclude)).select("path", "names")
    plain, zipped = stored(plain, "headers"), stored(zipped, "headers")
    known = plain.union(zipped).select(F.array_join("names", ",").alias("header"), F.posexplode("names").alias("at", "name"))
    if common_columns is not None:
        known = known.where(F.col("name").isin(list(common_columns)))
    found = [r.name for r in known.groupBy("name").agg(F.min(F.struct("header", "at")).alias("at")).orderBy("at").select("name").collect()]
    columns = found if common_columns is None else [c for c in common_columns if c in found]
    if not columns:
        names = common_columns or []
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in names]))
    rows = files.records.select("path", split_fields(F.col("record")).alias("values")).join(plain, "path")
    values = [F.get("values", F.array_position("names", F.lit(c)).cast("int") - 1) for c in columns]
    rows = rows.select(*[F.nullif(v, F.lit("")).alias(c) for v, c in zip(values, columns)])
    members = zip_records(spark, folder, columns).where("values is not null").join(zipped, "path", "left_semi")
    members = members.select(*[F.nullif(F.get("values", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])
    return rows.union(members)


def folder_files(spark: SparkSession, folder: str, exclude: str | None = None) -> DataFrame:
    """Rows (file, compression, loaded, error), one for each CSV file of a folder; ``error`` says why one is skipped.

    Spark does not list files without any bytes, so they are neither loaded nor skipped.
    """
    files = _listing(spark, folder, exclude)
    plain = _readable(spark, folder).select("path", F.lit(True).alias("loaded"), F.lit(None).cast("string").alias("error"))
    zipped = zip_headers(spark, folder).select("path", F.col("names").isNotNull().alias("loaded"), "error")
    loaded = F.coalesce("loaded", F.lit(False))
    error = F.when(~loaded, F.coalesce("error", F.lit("empty, or no readable line")))
    return files.join(plain.union(zipped), "path", "left").select("file", "compression", loaded.alias("loaded"), error.alias("error"))


def folder_summary(spark: SparkSession, folder: str, exclude: str | None = None) -> DataFrame:
    """Loaded and skipped files per compression."""
    return (
        folder_files(spark, folder, exclude)
        .groupBy("compression")
        .agg(F.count_if("loaded").alias("loaded_files"), F.count_if(~F.col("loaded")).alias("skipped_files"))
    )


def write_layer(df: DataFrame, path: str, order: Sequence[str] = ("datetime",)) -> str:
    """A Parquet layer, sorted so that scans can skip by time. ``df`` is computed once, into a scratch table.

    Give ``order`` a key after the time: rows of one time, or of none, are then spread like others.
    """
    df = stored(df, "layer")
    sorted_layer(require_rows(df, path), *order).write.mode("errorifexists").parquet(path)
    return path
