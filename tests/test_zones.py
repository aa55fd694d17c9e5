"""Keyed-state rules give the same rows whatever the session's time zone."""

import pytest
from pyspark.sql import functions as F

from millrace.session import ROCKSDB_PROVIDER
from millrace.streaming import visits as streams

ZONES = ["UTC", "Asia/Shanghai", "America/Los_Angeles"]
COLUMNS = "log_id long, mid string, page_id string, last_page_id string, millis long"

#: Visit starts of A, B, C, D in four files; D goes on after five seconds; X only moves the watermark.
BATCHES = [
    [(1, "A", "home", None, 10_000), (2, "D", "home", None, 11_000)],
    [(3, "D", "list", "home", 16_000), (4, "B", "home", None, 40_000)],
    [(5, "C", "home", None, 80_000)],
    [(6, "X", "list", "home", 400_000)],
    [(7, "X", "list", "home", 800_000)],
]


@pytest.fixture
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def replay(spark, tmp_path, build):
    source = str(tmp_path / "in")
    for k, rows in enumerate(BATCHES):
        spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(f"{source}/part={k}")
    raw = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(f"{source}/part=*")
    log = raw.withColumn("ts", F.timestamp_millis("millis")).withWatermark("ts", "0 seconds")
    query = (
        build(log).writeStream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
        .format("parquet").option("path", str(tmp_path / "out")).start()
    )
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("zone", ZONES, indirect=True)
def test_bounces(spark, tmp_path, zone):
    rows = replay(spark, tmp_path, streams.bounces).collect()
    assert sorted((r.mid, r.millis) for r in rows) == [("A", 10_000), ("B", 40_000), ("C", 80_000)]


@pytest.mark.parametrize("zone", ZONES, indirect=True)
def test_first_of_day(spark, tmp_path, zone):
    rows = replay(spark, tmp_path, streams.home_detail_visits).collect()
    assert sorted((r.mid, r.home_uv_ct) for r in rows) == [("A", 1), ("B", 1), ("C", 1), ("D", 1)]
