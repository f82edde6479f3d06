"""Column builders that turn raw text columns into lists, maps, timestamps and parts of strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.lookup import let

# Whitespace as Python's str methods and `\s` see it; Java's own `\s` is ASCII only.
WS = r"[\t-\r\x1C-\x1F \x85\p{Z}]"
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# CSV exports hold lists as Python literals, which are JSON but for quotes, escapes and names.
_LENIENT = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
_STRICT = {"allowSingleQuotes": "false"}
_QUOTED = r"""'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+\""""


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace, not only blanks."""
    return F.btrim(c, F.lit(_BLANKS))


def is_missing(c: Column, floating: bool = False) -> Column:
    """Null, or NaN for floating columns. Empty strings and zeros are present."""
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()


def _swap_name(c: Column, name: str, by: str) -> Column:
    """Replace a bare name wherever it stands outside of quotes."""
    head, tail = name[0], name[1:]
    skipped = rf"""(?:[^'"{head}]|{_QUOTED}|{head}(?!{tail}\b))*+"""
    return F.regexp_replace(c, rf"\G({skipped}){name}\b", "$1" + by)


def literal_to_json(c: Column) -> Column:
    """Text of a Python literal as JSON that still uses single quotes.

    Names that only JSON knows are made invalid, since they do not occur in a literal.
    """
    for name in ("true", "false", "null"):
        c = _swap_name(c, name, "?")
    for name, by in (("None", "null"), ("True", "true"), ("False", "false")):
        c = _swap_name(c, name, by)
    c = F.regexp_replace(c, r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    return F.regexp_replace(c, rf",{WS}*\]{WS}*$", "]")


def list_of(c: Column, schema: str, literal_only: bool = False) -> Column:
    """JSON list (unless ``literal_only``), else Python literal list, else null, read as ``schema``."""
    text = strip(c)
    parsed = F.from_json(literal_to_json(text), schema, _LENIENT)
    if not literal_only:
        parsed = F.coalesce(F.from_json(text, schema, _STRICT), parsed)
    return F.when(text.startswith("[") & text.endswith("]"), parsed)


def float_text(c: Column) -> Column:
    """Spark's text of a double (``1.0E20``) the way ``str`` renders it (``1e+20``).

    Spark writes an exponent outside of 0.001 to 10^7, ``str`` outside of 0.0001 to 10^16.
    """
    form = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    sign, lead, rest = (F.regexp_extract(c, form, i) for i in (1, 2, 3))
    power = F.regexp_extract(c, form, 4).try_cast("int")
    rest = F.when(rest == "0", "").otherwise(rest)
    digits, whole = F.concat(lead, rest), power + 1
    padded = F.concat(F.rpad(digits, whole, "0"), F.lit(".0"))
    split = F.concat(F.substr(digits, F.lit(1), whole), F.lit("."), F.substr(digits, whole + 1))
    plain = F.when(F.length(digits) <= whole, padded).otherwise(split)
    exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    exponent = F.when(F.abs(power) > 99, F.concat(F.when(power < 0, "-").otherwise("+"), F.abs(power).cast("string"))).otherwise(exponent)
    scientific = F.concat(lead, F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.lit("e"), exponent)
    return (
        F.when(~c.rlike(form), c)
        .when(power.between(7, 15), F.concat(sign, plain))
        .when(power == -4, F.concat(sign, F.lit("0.000"), digits))
        .otherwise(F.concat(sign, scientific))
    )


def _item_text(v: Column, token: Column) -> Column:
    """A list item as text the way ``str`` renders it. Nested items are rendered as JSON.

    ``token`` is the same item read as text: it still shows whether a number was written as a float.
    """
    text, kind = v.cast("string"), F.schema_of_variant(v)
    is_float = (kind == "DOUBLE") | (kind.startswith("DECIMAL") & token.contains("."))
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(text))
        .when(is_float, float_text(token))
        .when(kind.startswith("DECIMAL"), token)
        .otherwise(text)
    )


def _list_or_null(c: Column, literal_only: bool = False) -> Column:
    items, tokens = (list_of(c, f"array<{t}>", literal_only) for t in ("variant", "string"))
    return F.zip_with(items, tokens, _item_text)


def empty_list() -> Column:
    return F.array().cast("array<string>")


def parse_list(c: Column, fallback: Column | None = None) -> Column:
    """List of strings from a JSON or literal list; anything else gives ``fallback``."""
    return F.coalesce(_list_or_null(c), empty_list() if fallback is None else fallback)


def normalize_list(c: Column) -> Column:
    """As ``parse_list``, but a plain value becomes a list of one, and null an empty list."""
    return F.when(c.isNull(), empty_list()).otherwise(
        parse_list(c, F.array(c.cast("string")))
    )


def normalize_dicts(c: Column) -> Column:
    """List of maps; empty unless every item is an object."""
    none = F.array().cast("array<map<string,string>>")
    return let(
        list_of(c, "array<map<string,string>>"),
        lambda items: F.when(items.isNull() | F.exists(items, lambda m: m.isNull()), none).otherwise(items),
    )


def normalize_terms(c: Column, null_as_empty: bool = False) -> Column:
    """Search terms: a literal list, or one trimmed term. Null reads as the word None unless told not to."""
    on_null = empty_list() if null_as_empty else F.array(F.lit("None"))
    return F.when(c.isNull(), on_null).otherwise(
        F.coalesce(_list_or_null(c, literal_only=True), F.array(strip(c)))
    )


def safe_eval(c: Column) -> Column:
    """Literal lists only from text that opens a bracket; a broken list, or JSON's own names, are an error."""
    broken = F.raise_error(F.concat(F.lit("not a list: "), c)).cast("array<string>")
    return F.when(
        strip(c).startswith("["), F.coalesce(_list_or_null(c, literal_only=True), broken)
    ).otherwise(empty_list())


def _typed(df: DataFrame, name: str, from_text, item_type: T.DataType) -> Column:
    """Parse text columns; pass lists through with their items cast."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.ArrayType):
        items = c if kind.elementType == item_type else c.cast(T.ArrayType(item_type))
        return F.coalesce(items, F.array().cast(T.ArrayType(item_type)))
    return from_text(c if isinstance(kind, T.StringType) else c.cast("string"))


def with_lists(df: DataFrame, *names: str) -> DataFrame:
    """Make list-of-string columns out of text or list columns."""
    return df.withColumns({n: _typed(df, n, normalize_list, T.StringType()) for n in names})


def with_dicts(df: DataFrame, *names: str) -> DataFrame:
    """Make list-of-map columns out of text or list columns."""
    item = T.MapType(T.StringType(), T.StringType())
    return df.withColumns({n: _typed(df, n, normalize_dicts, item) for n in names})


def with_terms(df: DataFrame, name: str, null_as_empty: bool = False) -> DataFrame:
    """Make a search term list out of a text or list column."""
    if isinstance(df.schema[name].dataType, T.ArrayType):
        on_null = empty_list() if null_as_empty else F.array(F.lit("None"))
        return df.withColumn(name, F.coalesce(F.col(name).cast("array<string>"), on_null))
    return df.withColumn(name, normalize_terms(F.col(name).cast("string"), null_as_empty))


def pluck(items: Column, key: str) -> Column:
    """Values of ``key`` over the maps that have it, in order."""
    found = F.filter(items, lambda m: F.map_contains_key(m, key))
    return F.coalesce(F.transform(found, lambda m: F.try_element_at(m, F.lit(key))), empty_list())


def lower_items(items: Column) -> Column:
    return F.transform(F.filter(items, lambda x: x.isNotNull()), F.lower)


def after_last(c: Column, mark: str) -> Column:
    """What follows the last ``mark``; the whole text if there is none."""
    return F.substring_index(c, mark, -1)


def strip_tickers(items: Column) -> Column:
    """``CRYPTO:BTC`` → ``BTC`` for each item."""
    return F.transform(items, lambda x: after_last(x, ":"))


def strip_scheme(c: Column) -> Column:
    """``https://news.example`` → ``news.example``."""
    return after_last(c, "//")


def item_of(items: Column, symbol: str) -> Column:
    """The first item about a ticker, ignoring case; null if there is none."""
    return F.get(
        F.filter(items, lambda m: F.lower(F.try_element_at(m, F.lit("ticker"))) == symbol.lower()),
        F.lit(0),
    )


# The fields of a ticker item, in the order they are shown.
TICKER_FIELDS = ["ticker", "relevance_score", "ticker_sentiment_score", "ticker_sentiment_label"]


def item_columns(item: Column) -> list[Column]:
    """A ticker item as one column per field."""
    return [F.try_element_at(item, F.lit(f)).alias(f) for f in TICKER_FIELDS]


def parse_ts(c: Column, strict: bool = False) -> Column:
    """Zone-free time from basic (``20240419T153015``) or extended ISO text.

    Unreadable text gives null, or an error if ``strict``.
    """
    text = c.cast("string")
    extended = F.rtrim(
        F.regexp_replace(
            text, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})?$", "$1-$2-$3T$4:$5:$6"
        ),
        F.lit(":"),
    )
    return extended.cast("timestamp_ntz") if strict else extended.try_cast("timestamp_ntz")
