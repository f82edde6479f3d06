"""Mean sentiment per ticker and time bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions.lookup import let
from newsloom.functions.parse import after_last, list_of, with_lists
from newsloom.operators.validate import require_columns
from newsloom.session import scratch_path, stored

# Names of the frequencies and the interval each stands for.
FREQUENCIES = {"D": "1 day", "h": "1 hour"}


def _step(freq: str) -> Column:
    return F.expr(f"interval {FREQUENCIES[freq]}")


def mean_per_bucket(df: DataFrame, freq: str) -> DataFrame:
    """Mean ``score`` per bucket and ticker; pairs without any score are left out."""
    return (
        df.where(F.col("datetime").isNotNull() & F.col("ticker").isNotNull())
        .where(F.col("score").isNotNull() & ~F.isnan("score"))
        .groupBy(F.window("datetime", FREQUENCIES[freq]).start.alias("bucket"), "ticker")
        .agg(F.avg("score").alias("score"))
    )


def fill_calendar(means: DataFrame, freq: str, fill: float | None = None) -> DataFrame:
    """Every ticker gets every bucket from the first to the last one of the table.

    Each row is stretched up to the next row of its ticker, which needs neither a calendar table
    nor a join. The bounds of the table are a scalar subquery; it looks at the means and not just
    at the buckets, so that it reads the same shuffled data as the series itself. At most one row
    per bucket and ticker gets here, so a window is as long as the calendar. Rows without a score do not count.
    """
    means = means.where(F.col("score").isNotNull())
    bounds = means.agg(F.struct(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"), F.max("score"))).scalar()
    by_ticker = Window.partitionBy("ticker").orderBy("bucket")
    spans = means.select(
        "ticker",
        "score",
        "bucket",
        F.row_number().over(by_ticker).alias("n"),
        F.lead("bucket").over(by_ticker).alias("next"),
    ).select(
        "ticker",
        "score",
        F.col("bucket").alias("at"),
        F.explode(
            F.sequence(
                F.when(F.col("n") == 1, bounds["lo"]).otherwise(F.col("bucket")),
                F.coalesce(F.col("next") - _step(freq), bounds["hi"]),
                _step(freq),
            )
        ).alias("bucket"),
    )
    score = F.when(F.col("bucket") == F.col("at"), F.col("score"))
    if fill is not None:
        score = F.coalesce(score, F.lit(float(fill)))
    return spans.select("bucket", "ticker", score.alias("score"))


def fill_scores(series: DataFrame, value: float) -> DataFrame:
    """A constant in place of missing scores."""
    return series.fillna(value, ["score"])


def ticker_scores(df: DataFrame, suffix: str = "nltk") -> DataFrame:
    """One row per article and ticker, with the article's score."""
    score = f"sentiment_score_{suffix}"
    require_columns(df, ["datetime", "ticker_names", score])
    return with_lists(df.select("datetime", "ticker_names", score), "ticker_names").select(
        "datetime",
        F.explode("ticker_names").alias("ticker"),
        F.col(score).cast("double").alias("score"),
    )


def nested_scores(df: DataFrame, clean_tickers: bool = True) -> DataFrame:
    """One row per article and listed ticker, with the source's own score of that ticker.

    Text is parsed straight into the two fields that are needed.
    """
    require_columns(df, ["datetime", "ticker_sentiment"])
    items = F.col("ticker_sentiment")
    if dict(df.dtypes)["ticker_sentiment"] == "string":
        items = list_of(items, "array<struct<ticker:string,ticker_sentiment_score:string>>")
        items = let(items, lambda xs: F.when(~F.exists(xs, lambda x: x.isNull()), xs))
        ticker, score = F.col("i.ticker"), F.col("i.ticker_sentiment_score")
    else:
        ticker, score = (
            F.try_element_at("i", F.lit(k)) for k in ("ticker", "ticker_sentiment_score")
        )
    exploded = df.select("datetime", F.explode(items).alias("i")).select(
        "datetime", ticker.alias("ticker"), score.alias("score")
    )
    name = after_last(F.col("ticker"), ":") if clean_tickers else F.col("ticker")
    return exploded.where((F.col("ticker") != "") & F.col("score").isNotNull()).select(
        "datetime", name.alias("ticker"), F.col("score").cast("double").alias("score")
    )


def resample_scores(
    df: DataFrame, suffix: str = "nltk", freq: str = "D", fill: float | None = None
) -> DataFrame:
    """Mean article score per bucket and ticker, as a gapless long series."""
    return fill_calendar(mean_per_bucket(ticker_scores(df, suffix), freq), freq, fill)


def resample_nested(
    df: DataFrame, freq: str = "D", fill: float | None = None, clean_tickers: bool = True
) -> DataFrame:
    """Mean of the source's own ticker scores per bucket and ticker, as a gapless long series."""
    return fill_calendar(mean_per_bucket(nested_scores(df, clean_tickers), freq), freq, fill)


def pivot_scores(series: DataFrame, tickers: Sequence[str] | None = None) -> DataFrame:
    """Wide form: one row per bucket and one column per ticker, by name.

    Pass the tickers to save the job that looks them up; Spark bounds their number otherwise.
    """
    by_bucket = series.groupBy("bucket").pivot("ticker", sorted(tickers) if tickers else None)
    return by_bucket.agg(F.first("score"))


def write_wide(series: DataFrame, path: str, width: int = 1000) -> list[str]:
    """The wide form of any number of tickers, as tables of up to ``width`` ticker columns each; their paths.

    Tickers are dealt to blocks by name. One shuffle brings the scores of a bucket and block together; each block is then
    one scan of its own folder, and has every bucket, as a wide table would. A column for each ticker is what the driver
    has to name, so the names are all that it holds.
    """
    spark = series.sparkSession
    names = [r.ticker for r in series.where("ticker is not null").select("ticker").distinct().orderBy("ticker").toLocalIterator()]
    if "bucket" in names:
        raise ValueError("a ticker named bucket cannot be a column beside the buckets")
    blocks = [names[i : i + width] for i in range(0, len(names), width)]
    first = F.array(*[F.lit(b[0]) for b in blocks]).cast("array<string>")
    block = F.size(F.filter(first, lambda f: f <= F.col("ticker"))) - 1
    dealt = series.where("ticker is not null").withColumn("_block", block)
    # Of several scores of a bucket and ticker, the wide form has one; the smallest, so that reruns agree.
    single = dealt.groupBy("bucket", "_block", "ticker").agg(F.min("score").alias("score"))
    maps = single.groupBy("bucket", "_block").agg(F.map_from_entries(F.collect_list(F.struct("ticker", "score"))).alias("scores"))
    folder = scratch_path(spark, "wide")
    maps.write.partitionBy("_block").parquet(folder)
    buckets = stored(series.select("bucket").distinct(), "buckets")
    paths = []
    for i, tickers in enumerate(blocks):
        scores = spark.read.schema(maps.schema).parquet(folder).where(F.col("_block") == i)
        wide = buckets.join(scores.drop("_block"), "bucket", "left")
        columns = [F.try_element_at("scores", F.lit(t)).alias(t) for t in tickers]
        paths.append(f"{path}/block={i:05d}")
        wide.select("bucket", *columns).write.mode("errorifexists").parquet(paths[-1])
    return paths


def read_wide(spark: SparkSession, paths: Sequence[str], tickers: Sequence[str]) -> DataFrame:
    """Some tickers out of the blocks of ``write_wide``: only the blocks and columns that hold them are read."""
    out = None
    for path in paths:
        table = spark.read.parquet(path)
        wanted = [t for t in tickers if t in table.columns and t != "bucket"]
        if wanted:
            part = table.select("bucket", *[F.col(f"`{t}`") for t in wanted])
            out = part if out is None else out.join(part, "bucket")
    if out is None:
        raise KeyError(f"no such tickers: {list(tickers)}")
    return out.select("bucket", *[F.col(f"`{t}`") for t in tickers])
