"""A keyed table in hash buckets of its key, rewritten bucket by bucket.

A micro-batch changes only the buckets its keys fall in: their rows and the batch's are put together, the latest version of each key is written as the
buckets' new files, and a manifest says which version of every bucket holds. Readers get each key once, without an exchange, however long the history is.

A version is in force when its manifest is complete. A batch that is repeated finds its manifest and does nothing; one that failed half way is written again under the same
names. Versions that no manifest in use names can be removed by a clean-up rule of the folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.changelog import latest_by_key

_MANIFEST = "bucket int, version long"


class KeyedTable:
    """The rows of ``schema`` by ``keys``; of versions of a key the last by ``order`` holds, and equal ones the later batch's.

    ``buckets`` is fixed when the table is made: about the largest size of the table over 1 GB. ``deleted`` is a condition under which a version removes its key; removed keys
    are kept as rows until ``order`` can't bring an older version any more, so reading leaves them out.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str], buckets: int = 64, deleted: str | None = None):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.order, self.buckets, self.deleted = list(keys), list(order), buckets, deleted

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def versions(self, batch_id: int | None = None) -> dict[int, int] | None:
        """Version by bucket: of the last manifest, or of one batch's; None if there is none. One number per bucket comes to the driver."""
        listed = self.spark.read.schema(f"{_MANIFEST}, batch_id long")
        try:
            rows = listed.parquet(f"{self.path}/manifest") if batch_id is None else listed.parquet(f"{self.path}/manifest/batch_id={batch_id}")
        except AnalysisException:
            return None
        if batch_id is None:
            last = rows.agg(F.max("batch_id")).first()[0]
            rows = rows.where(F.col("batch_id") == F.lit(last))
        return {r["bucket"]: r["version"] for r in rows.collect()}

    def _read(self, versions: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """A micro-batch writer."""
        if self.versions(batch_id) is not None:
            return
        before = self.versions() or {}
        names = self.schema.fieldNames()
        # one version per key and batch, reduced where the rows are read
        rows = latest_by_key(batch.select(names), self.keys, self.order).withColumn("bucket", self._bucket()).persist()
        try:
            touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]
            old = self._read({b: before[b] for b in touched if b in before}).withColumn("bucket", self._bucket())
            both = old.withColumn("_batch", F.lit(0)).unionByName(rows.withColumn("_batch", F.lit(1)))
            merged = latest_by_key(both, ["bucket", *self.keys], [*self.order, "_batch"]).drop("_batch")
            merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={batch_id}")
        finally:
            rows.unpersist()
        after = before | dict.fromkeys(touched, batch_id)
        manifest = self.spark.createDataFrame(sorted(after.items()), _MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/batch_id={batch_id}")

    def read(self) -> DataFrame:
        """The table as it stands."""
        rows = self._read(self.versions() or {})
        return rows if self.deleted is None else rows.where(~F.coalesce(F.expr(self.deleted), F.lit(False)))
