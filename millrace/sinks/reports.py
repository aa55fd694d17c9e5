"""Outputs of the jobs: reports to a store, records to topics, and the start of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.session import several_states
from millrace.sinks.changelog import BatchWriter

# How often state is committed, and how long a topic transaction may last.
COMMIT_INTERVAL = "5 seconds"
TRANSACTION_TIMEOUT_MILLIS = 15 * 60 * 1000


def report_writer(
    columns: Sequence[str], format: str = "jdbc", skip: Sequence[str] = (), **options: str
) -> BatchWriter:
    """A micro-batch writer that inserts the named columns in their order, without the ``skip`` ones.

    For JDBC set ``url``, ``dbtable``, ``driver``; ``batchsize`` rows go into one statement and ``numPartitions``
    bounds the connections. A repeated batch is inserted again, so the store should replace rows by window and key.
    """
    kept = [c for c in columns if c not in skip]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(*kept).write.format(format).options(**options).mode("append").save()

    return write


def topic_frame(df: DataFrame, topic: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Rows as ``topic, key, value`` for a Kafka write. Rows that carry ``topic, value`` already stay as they are."""
    if topic is None:
        return df.select("topic", "value")
    key = F.to_json(F.struct(*keys)) if keys else F.lit(None).cast("string")
    return df.select(F.lit(topic).alias("topic"), key.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def topic_options(servers: str) -> dict[str, str]:
    """Writer options. Delivery is at least once; keyed records make repeats harmless."""
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.transaction.timeout.ms": str(TRANSACTION_TIMEOUT_MILLIS),
        "kafka.enable.idempotence": "true",
        "kafka.acks": "all",
    }


def start_topic_stream(df: DataFrame, servers: str, checkpoint: str, interval: str = COMMIT_INTERVAL) -> StreamingQuery:
    """Publish ``topic, key, value`` rows continuously."""
    writer = df.writeStream.format("kafka").options(**topic_options(servers))
    with several_states(df.sparkSession):
        return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def start_stream(
    df: DataFrame,
    checkpoint: str,
    write: BatchWriter | None = None,
    path: str | None = None,
    interval: str | None = COMMIT_INTERVAL,
) -> StreamingQuery:
    """Run a stream into a batch writer, or exactly once into Parquet files under ``path``.

    ``checkpoint`` keeps offsets and state; a restart continues from it. ``interval`` None works off what is there
    and stops.
    """
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    stream = df.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
    with several_states(df.sparkSession):
        if write is not None:
            return stream.foreachBatch(write).start()
        return stream.format("parquet").option("path", path).outputMode("append").start()


def start_print(df: DataFrame, rows: int = 20) -> StreamingQuery:
    """Show the results of a stream on the console."""
    with several_states(df.sparkSession):
        return df.writeStream.format("console").option("numRows", rows).option("truncate", "false").start()
