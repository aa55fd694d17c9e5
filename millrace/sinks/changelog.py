"""Keyed tables kept as a log of changes, read as the latest version per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from millrace.operators.changelog import latest_by_key

BatchWriter = Callable[[DataFrame, int], None]


def append_changes(path: str, partition_by: Sequence[str] = ()) -> BatchWriter:
    """A micro-batch writer that adds each batch as its own folder.

    A batch repeated after a failure replaces its folder, so nothing is stored twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")

    return write


def read_changes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All stored versions, with the ``batch_id`` they came in."""
    full = StructType(list(schema.fields)).add("batch_id", LongType())
    return spark.read.schema(full).parquet(path)


def read_latest(
    spark: SparkSession, path: str, schema: StructType, keys: str | Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """The table as it stands: the version of each key that came last."""
    return latest_by_key(read_changes(spark, path, schema), keys, ("batch_id", *order)).drop("batch_id")


def compact(
    spark: SparkSession, path: str, target: str, schema: StructType, keys: str | Sequence[str], order: Sequence[str] = ()
) -> None:
    """Write only the last version of each key to the new folder ``target``, in the same layout.

    A stopped stream continues there under its old checkpoint; ``path`` stays until it is no longer read.
    """
    latest = latest_by_key(read_changes(spark, path, schema), keys, ("batch_id", *order))
    latest.repartition("batch_id", *([keys] if isinstance(keys, str) else keys)).write.partitionBy("batch_id").parquet(target)


def key_and_value(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows as JSON ``key`` and ``value`` texts, the form of a keyed topic."""
    return df.select(
        F.to_json(F.struct(*keys)).alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )
