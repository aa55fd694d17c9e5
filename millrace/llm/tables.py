"""Reading the given tables, and tables that cut lineage in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_dir


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read again: lost executors cost no recomputation of what led here."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """Queries run in this block send rows to Python in batches of about ``n_bytes``, and a longer row alone.

    By default a batch has 10,000 rows or 64 MB, which Spark and the worker each hold, whatever the worker then takes from it at once.
    """
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, str(n_bytes))
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


#: Ids are broadcast only up to this many (16 bytes each); more are joined by shuffle.
BROADCAST_IDS = 2_000_000


def counted(ids: DataFrame) -> DataFrame:
    """The ids for a join: with a broadcast hint if a count shows that they are few, as they are otherwise."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
