"""Delivery of a stream's rows exactly once, in two phases, as a data source of its own.

Tasks stage their rows as files under names nobody reads. When all tasks of a micro-batch are done, the driver names their files in one commit file of that batch, put
in place by a rename. Readers follow the commit files alone. A batch that failed before its commit left files that nothing names; one that is repeated after its commit,
because the stream stopped before it noted the batch as done, finds the commit file and leaves it as it is. Sources and checkpoint give the same rows to a batch each
time, so no row is lost or doubled.

    spark.dataSource.register(delivery.Delivery)
    df.writeStream.format("delivery").option("path", folder).option("checkpointLocation", checkpoint).start()
    delivery.read_delivered(spark, folder, df.schema)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from millrace.session import several_states

_COMMIT = "batch_id long, file string, n_rows long"


def _file_system(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class Staged(WriterCommitMessage):
    """The file a task has staged, if it had rows."""

    file: str | None
    n_rows: int


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        name, n_rows, writer, out = f"staged/{uuid.uuid4().hex}.parquet", 0, None, None
        system, inner = _file_system(self.path)
        try:
            for batch in iterator:
                if writer is None:
                    system.create_dir(f"{inner}/staged", recursive=True)
                    out = system.open_output_stream(f"{inner}/{name}")
                    writer = pq.ParquetWriter(out, batch.schema)
                writer.write_batch(batch)
                n_rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
                out.close()
        return Staged(name if n_rows else None, n_rows)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        from pyarrow import fs

        system, inner = _file_system(self.path)
        target = f"{inner}/commits/{batchId:010d}.json"
        if system.get_file_info(target).type != fs.FileType.NotFound:
            return  # a repeated batch: what was delivered stays
        system.create_dir(f"{inner}/commits", recursive=True)
        lines = [json.dumps({"batch_id": batchId, "file": m.file, "n_rows": m.n_rows}) for m in messages if m is not None and m.file]
        temporary = f"{inner}/commits/_{batchId:010d}.{uuid.uuid4().hex}"
        with system.open_output_stream(temporary) as out:
            out.write("".join(f"{line}\n" for line in lines).encode())
        system.move(temporary, target)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        """Staged files without a commit are never read."""


class Delivery(DataSource):
    """Sink ``delivery`` with the option ``path``, a folder that driver and executors share."""

    @classmethod
    def name(cls) -> str:
        return "delivery"

    def schema(self) -> str:
        raise NotImplementedError("delivered rows are read with read_delivered")

    def streamWriter(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def read_delivered(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of committed batches, with ``batch_id``."""
    full = StructType(list(schema.fields)).add("batch_id", "long")
    commits = spark.read.schema(_COMMIT).json(f"{path}/commits").where(F.col("file").isNotNull())
    files = [(r["file"].rsplit("/", 1)[1], r["batch_id"]) for r in commits.select("file", "batch_id").toLocalIterator()]
    if not files:
        return spark.createDataFrame([], full)
    # a name per task and batch; rows are tied to their batch by the file they lie in
    names = F.broadcast(spark.createDataFrame(files, "_file string, batch_id long")) if len(files) <= 100_000 else spark.createDataFrame(files, "_file string, batch_id long")
    rows = spark.read.schema(schema).parquet(*[f"{path}/staged/{name}" for name, _ in files])
    return rows.withColumn("_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).join(names, "_file").drop("_file")


def start_delivery(df: DataFrame, path: str, checkpoint: str, interval: str | None = None):
    """Starts the stream; ``interval`` None works off what is there and stops."""
    df.sparkSession.dataSource.register(Delivery)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    stream = df.writeStream.format("delivery").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger)
    with several_states(df.sparkSession):
        return stream.start()
