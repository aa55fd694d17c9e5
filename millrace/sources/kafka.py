"""Kafka topics as text or as declared records. The connector is a cluster package, so these are option builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_options(servers: str, topic: str, starting: str = "earliest", max_per_trigger: int = 50_000_000) -> dict[str, str]:
    """Reader options.

    Offsets are kept in the query's checkpoint, so ``starting`` matters on the first run only. The trigger limit
    bounds how much one micro-batch, and so one hot key within it, can hold.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(max_per_trigger),
        "failOnDataLoss": "true",
    }


def read_topic(spark: SparkSession, servers: str, topic: str, streaming: bool = True, **options: str) -> DataFrame:
    """Topic as ``value`` text with its ``log_id``; tombstones (null values) of upsert topics are left out."""
    reader = spark.readStream if streaming else spark.read
    settings = {**kafka_options(servers, topic), **options}
    if not streaming:
        settings.pop("maxOffsetsPerTrigger")
    return topic_text(reader.format("kafka").options(**settings).load())


def topic_text(raw: DataFrame) -> DataFrame:
    """Text rows of a Kafka-shaped frame (``value, partition, offset``)."""
    return raw.where(F.col("value").isNotNull()).select(
        F.col("value").cast("string").alias("value"),
        F.format_string("%010d-%020d", F.col("partition"), F.col("offset")).alias("log_id"),
    )


def as_records(text: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """JSON text rows as columns of ``schema``; other columns are kept."""
    kept = [c for c in text.columns if c != value]
    return text.select(*kept, F.from_json(value, schema).alias("_record")).select(*kept, "_record.*")
