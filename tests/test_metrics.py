"""Rows in = rows counted + rows late."""

import time

from pyspark.sql import functions as F

from millrace.session import shared_dir
from millrace.sinks.reports import start_stream
from millrace.streaming import metrics
from millrace.streaming import visits as streams

SCHEMA = "id string, order_id string, user_id string, sku_id string, ts timestamp"


def test_late_rows_are_counted(spark, tmp_path):
    path, out, state = str(tmp_path / "in"), str(tmp_path / "out"), shared_dir(spark, "late")
    counts = metrics.watch(spark)
    try:
        total, ids = 0, set()
        # the third micro-batch holds rows of long ago besides new ones
        for first, seconds in ((0, range(0, 100)), (1000, range(100, 200)), (2000, [*range(200, 230), *range(0, 40)])):
            rows = [(str(first + k), f"o{k % 7}", f"u{k % 5}", f"s{k % 3}", s) for k, s in enumerate(seconds)]
            total += len(rows)
            frame = spark.createDataFrame(rows, "id string, order_id string, user_id string, sku_id string, s long")
            frame.select("id", "order_id", "user_id", "sku_id", F.timestamp_seconds(F.col("s") + 100_000).alias("ts")).write.mode("append").parquet(path)
            log = metrics.counted_in(spark.readStream.schema(SCHEMA).parquet(path))
            marked = streams.mark_new_orders(streams.with_watermark(log), "10 seconds")
            query = start_stream(marked, state, path=out, interval=None)
            query.awaitTermination()
            ids.add(str(query.id))
        (query_id,) = ids
        for _ in range(40):  # reports come a little after the query
            if counts.taken(query_id) == total:
                break
            time.sleep(0.5)
        kept = spark.read.schema(marked.schema).parquet(out)
        assert counts.taken(query_id) == total == 270
        assert counts.late(query_id) == 40 and kept.count() == total - 40
        assert kept.where("new_order = 1").count() == kept.select(F.window("ts", "10 seconds"), "sku_id", "order_id").distinct().count()
    finally:
        spark.streams.removeListener(counts)
