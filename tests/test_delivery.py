"""Delivery in two phases: batches that fail before their commit, and batches repeated after it."""

import glob
import os

import pytest

from millrace.sinks import delivery

SCHEMA = "k long, text string"


def put(spark, path, low, high):
    spark.range(low, high).selectExpr("id AS k", "concat('t', id) AS text").repartition(3).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).parquet(path)


def delivered(spark, out):
    schema = spark.createDataFrame([], SCHEMA).schema
    return sorted((r.k, r.text, r.batch_id) for r in delivery.read_delivered(spark, out, schema).collect())


def test_no_row_is_lost_or_doubled(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put(spark, source, 0, 50)
    delivery.start_delivery(stream(spark, source), out, state).awaitTermination()
    put(spark, source, 50, 80)
    delivery.start_delivery(stream(spark, source), out, state).awaitTermination()
    expected = [(k, f"t{k}", 0 if k < 50 else 1) for k in range(80)]
    assert delivered(spark, out) == expected
    # the stream stopped after the commit and before it noted the batch as done: the batch is repeated
    for name in glob.glob(f"{state}/commits/*1*") + glob.glob(f"{state}/commits/.*1*"):
        os.remove(name)
    staged = len(os.listdir(f"{out}/staged"))
    delivery.start_delivery(stream(spark, source), out, state).awaitTermination()
    assert len([f for f in os.listdir(f"{out}/staged") if f.endswith(".parquet")]) > 0 and len(os.listdir(f"{out}/staged")) > staged
    assert delivered(spark, out) == expected
    # it stopped before the commit: what was staged counts for nothing, and the batch is done again
    os.remove(f"{out}/commits/{1:010d}.json")
    assert delivered(spark, out) == expected[:50]
    for name in glob.glob(f"{state}/commits/*1*") + glob.glob(f"{state}/commits/.*1*"):
        os.remove(name)
    put(spark, source, 80, 90)
    delivery.start_delivery(stream(spark, source), out, state).awaitTermination()
    assert delivered(spark, out) == [*expected, *((k, f"t{k}", 2) for k in range(80, 90))]


def test_a_failing_task_delivers_nothing(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put(spark, source, 0, 20)
    bad = stream(spark, source).selectExpr("k", "CASE WHEN k = 13 THEN raise_error('broken') ELSE text END AS text")
    with pytest.raises(Exception, match="broken"):
        delivery.start_delivery(bad, out, state).awaitTermination()
    assert not glob.glob(f"{out}/commits/*.json")
    delivery.start_delivery(stream(spark, source), out, state).awaitTermination()
    assert [k for k, _, _ in delivered(spark, out)] == list(range(20))
