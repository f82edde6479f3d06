"""Session helpers shared by the library, the bench and the tests."""

from __future__ import annotations

import gc
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "newsloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for intermediate tables, in the folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``, or one in its warehouse, which executors
    share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/newsloom/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are done: it does once the driver has collected their garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def dimension(spark: SparkSession, **columns: list) -> DataFrame:
    """A small table from driver constants.

    It is planned as a local relation, so Catalyst knows its exact size and broadcasts it only
    while it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return spark.createDataFrame(pa.table(columns))
