"""Guards and profiles of raw data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.lookup import let
from newsloom.functions.parse import list_of, literal_to_json, strip


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail before any plan is built if columns are missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"Missing columns: {missing}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail on an empty table. Starts a job that stops at the first row, so use it at layer writes."""
    if df.isEmpty():
        raise ValueError(f"No data returned: {what}")
    return df


def reject_reason(payload: Column, key: str = "results", check_status: bool = True) -> Column:
    """Why a landed API answer is unusable, or null if it is fine."""
    text = strip(payload)

    def judge(answer: Column) -> Column:
        value = F.try_variant_get(answer, f"$.{key}", "variant")
        items = F.size(F.try_variant_get(value, "$", "array<variant>"))
        scalar = F.try_variant_get(value, "$", "string")
        empty = (
            F.is_variant_null(value)
            | (F.coalesce(items, F.lit(1)) == 0)
            | F.coalesce(scalar.isin("", "0", "0.0", "false", "{}", "[]"), F.lit(False))
        )
        status = F.try_variant_get(answer, "$.status", "string")
        failed = F.lit(check_status) & ~F.coalesce(status == "success", F.lit(False))
        return (
            F.when(answer.isNull() | text.startswith('"'), "string")
            .when(~text.startswith("{"), "not_an_object")
            .when(failed, "bad_status")
            .when(value.isNull(), "missing_key")
            .when(empty, "empty_key")
        )

    return let(F.try_parse_json(text), judge)


def kind_of(c: Column) -> Column:
    """The kind of value a raw text holds: null, number, bool, list, dict or string."""
    text = strip(c)
    as_dict = F.coalesce(
        F.from_json(text, "map<string,string>"),
        F.from_json(literal_to_json(text), "map<string,string>", {"allowSingleQuotes": "true"}),
    )
    braced = text.startswith("{") & text.endswith("}")
    return (
        F.when(c.isNull(), "null")
        .when(list_of(c, "array<variant>").isNotNull(), "list")
        .when(braced & as_dict.isNotNull(), "dict")
        .when(text.isin("True", "False", "true", "false"), "bool")
        .when(text.try_cast("double").isNotNull(), "number")
        .otherwise("string")
    )


def _shares(df: DataFrame) -> DataFrame:
    counts = df.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("kind", "n", (F.col("n") / total).alias("share"))


def kind_profile(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of each kind of value in a raw column."""
    return _shares(df.select(kind_of(F.col(column)).alias("kind")))


def element_kind_profile(df: DataFrame, column: str) -> DataFrame:
    """As ``kind_profile`` over list items. An empty list counts as one null, text as itself."""
    c = F.col(column)
    kind = (
        F.when(F.col("v").isNull() | F.is_variant_null("v"), "null")
        .when(F.schema_of_variant("v") == "BOOLEAN", "bool")
        .when(F.schema_of_variant("v").startswith("OBJECT"), "dict")
        .when(F.schema_of_variant("v").startswith("ARRAY"), "list")
        .when(F.schema_of_variant("v") == "STRING", "string")
        .otherwise("number")
    )
    listed = df.select(c.alias("raw"), list_of(c, "array<variant>").alias("items"))
    plain = F.col("items").isNull()
    exploded = listed.select(
        "raw", plain.alias("plain"), F.explode_outer("items").alias("v")
    ).select(F.when(F.col("plain"), kind_of(F.col("raw"))).otherwise(kind).alias("kind"))
    return _shares(exploded)
