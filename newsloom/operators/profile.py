"""Schema profile and version span of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.validate import require_columns


def _type_name(kind: T.DataType) -> str:
    """Engine-neutral name of a column type."""
    names = [
        (T.StringType, "string"),
        (T.BooleanType, "boolean"),
        ((T.TimestampType, T.TimestampNTZType, T.DateType), "datetime64[ns]"),
        (T.ArrayType, "list"),
        ((T.MapType, T.StructType), "dict"),
        (T.DoubleType, "float64"),
        (T.FloatType, "float32"),
        (T.LongType, "int64"),
        (T.IntegerType, "int32"),
        (T.ShortType, "int16"),
        (T.ByteType, "int8"),
    ]
    return next((name for cls, name in names if isinstance(kind, cls)), "object")


def _text(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(F.col(name)) if nested else F.col(name).cast("string")


def schema_profile(df: DataFrame, seq: str = "_seq", sample_size: int = 2, normalize_types: bool = True) -> DataFrame:
    """Per column: name, type, whether it has nulls, and its first ``sample_size`` different values (``example_1`` on).

    Each aggregate over the table has one row; the one for the n-th example looks past those before, which reach it as
    scalar subqueries, so there is a scan for each example. Without an ordinal column the smallest values are shown.
    Types have engine-neutral names, or Spark's own without ``normalize_types``.
    """
    names = [c for c in df.columns if c != seq]
    ordinal = [F.col(seq).alias("_o")] if seq in df.columns else []
    texts = df.select(*ordinal, *[_text(df, c).alias(c) for c in names])
    earlier: list[Column] = []

    def example(i: int, c: str, past: int) -> Column:
        """The first value that is none of the first ``past`` examples; without so many there is none."""
        different = F.col(c).isNotNull()
        for found in earlier[:past]:
            different &= F.col(c) != found[f"c{i}"]
        return F.min_by(c, F.when(different, F.col("_o" if ordinal else c)))

    for n in range(sample_size - 1):
        earlier.append(texts.agg(F.struct(*[example(i, c, n).alias(f"c{i}") for i, c in enumerate(names)])).scalar())
    summary = texts.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(c).alias("name"),
                    F.lit(_type_name(df.schema[c].dataType) if normalize_types else df.schema[c].dataType.simpleString()).alias("type"),
                    (F.count_if(F.col(c).isNull()) > 0).alias("nullable"),
                    *[example(i, c, n).alias(f"example_{n + 1}") for n in range(sample_size)],
                )
                for i, c in enumerate(names)
            ]
        ).alias("profile")
    )
    return summary.select(F.inline("profile"))


def version_span(df: DataFrame) -> DataFrame:
    """Earliest and latest ``datetime`` in the form used in names of versioned files."""
    require_columns(df, ["datetime"])
    form = "yyyyMMdd'T'HHmm"
    return df.agg(
        F.date_format(F.min("datetime"), form).alias("first"),
        F.date_format(F.max("datetime"), form).alias("last"),
    )
