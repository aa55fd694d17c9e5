"""A chain of jobs over topics kept as folders of JSON lines: raw logs to reports."""

import json
import os

import pytest
from pyspark.sql import functions as F

from millrace import codes, schemas
from millrace.operators import log_split, visits, windows
from millrace.operators.trade import DimensionChain
from millrace.plans import feeds, programs
from millrace.plans.launch import job_frame, output_frame, start_job
from millrace.sinks.dims import route_and_store
from millrace.sources import click_log
from millrace.sources.tables import config_changes

# Fixed values in this file: names of the published topics.
ROW = "log_id string, value string"


@pytest.fixture(scope="module")
def topics(spark, folder, tmp_path_factory):
    """Folder per topic; ``publish`` appends ``topic, value`` rows, ``read`` gives a stream of them."""
    root = str(tmp_path_factory.mktemp("topics"))

    def publish(batch, batch_id):
        rows = batch.select("topic", F.expr("uuid()").alias("log_id"), "value")
        rows.write.mode("append").partitionBy("topic").parquet(root)

    def read(topic):
        os.makedirs(f"{root}/topic={topic}", exist_ok=True)
        return spark.readStream.schema(ROW).parquet(f"{root}/topic={topic}")

    text = feeds.click_log_text(spark, folder)
    publish(text.select(F.lit("topic_log").alias("topic"), "value"), 0)
    changes = feeds.change_log(spark, folder, "cart")
    publish(changes.select(F.lit("topic_db").alias("topic"), F.to_json(F.struct(*changes.columns)).alias("value")), 0)
    return root, publish, read


def work_off(spark, name, topics, tmp_path_factory, write=None, **sides):
    _, publish, read = topics
    query = start_job(name, read, write or publish, str(tmp_path_factory.mktemp("state")), interval=None, **sides)
    assert query.awaitTermination(200) and query.exception() is None


def test_click_log_chain(spark, folder, topics, tmp_path_factory):
    root, _, read = topics
    work_off(spark, "log_split", topics, tmp_path_factory)
    text = feeds.click_log_text(spark, folder)
    expected = programs.click_log_topics(text).groupBy("topic").count()
    published = spark.read.parquet(root).where("topic LIKE 'dwd_traffic%' OR topic = 'dirty_data'").groupBy("topic").count()
    assert sorted(map(tuple, published.collect())) == sorted(map(tuple, expected.collect()))

    work_off(spark, "unique_visitor", topics, tmp_path_factory)
    pages = click_log.page_columns(
        log_split.page_records(visits.repair_new_flag_records(click_log.clean_records(click_log.parse_log(text))))
    )
    stored = spark.read.parquet(root).where("topic = 'dwd_traffic_unique_visitor_detail'")
    devices = stored.select(F.get_json_object("value", "$.mid").alias("mid")).groupBy("mid").count()
    assert sorted(map(tuple, devices.collect())) == sorted(map(tuple, visits.unique_visitors(pages).groupBy("mid").count().collect()))

    parts = []
    work_off(spark, "keyword_window", topics, tmp_path_factory, write=lambda b, i: parts.extend(b.collect()))
    keywords = windows.keyword_window(pages)
    got = {(r.stt, r.keyword, r.keyword_count) for r in parts}
    assert got and got <= {(r.stt, r.keyword, r.keyword_count) for r in keywords.collect()}
    assert tuple(parts[0].asDict()) == schemas.KEYWORD_WINDOW


def test_cart_chain(spark, folder, topics, tmp_path_factory):
    root, _, _ = topics
    work_off(spark, "cart_add", topics, tmp_path_factory, dictionary=codes.code_dictionary(spark))
    stored = spark.read.parquet(root).where("topic = 'dwd_trade_cart_add'")
    facts = stored.select(F.from_json("value", schemas.CART_ADD_RECORD).alias("r")).select("r.*")
    expected = programs.cart_add(feeds.cart_changes(spark, folder), codes.code_dictionary(spark))
    assert sorted(map(tuple, facts.collect())) == sorted(map(tuple, expected.collect()))


def _product_tables(spark):
    names = ("spu_name", "tm_name", "name, category2_id", "name, category1_id", "name")
    empty = [spark.createDataFrame([], ", ".join(f"{c} string" for c in f"id, {n}".split(", "))) for n in names]
    sku = spark.createDataFrame([], "id string, sku_name string, spu_id string, tm_id string, category3_id string")
    return sku, DimensionChain(*empty)


def test_report_without_its_dimensions_fails(spark, topics):
    with pytest.raises(ValueError, match="trademark_name"):
        output_frame("sku_order_window", job_frame("sku_order_window", topics[2], sku=_product_tables(spark)[0]))


def test_dimension_job(spark, topics, tmp_path, tmp_path_factory):
    entry = {"source_table": "cart_info", "sink_table": "dim_cart", "sink_columns": "id,sku_id"}
    text = spark.createDataFrame([(json.dumps({"op": "r", "ts_ms": 1, "after": entry}),)], "value string")
    write = route_and_store(lambda: config_changes(text), str(tmp_path / "dims"))
    work_off(spark, "dim", topics, tmp_path_factory, write=write)
    changes = spark.read.parquet(topics[0]).where("topic = 'topic_db'")
    ids = changes.select(F.get_json_object("value", "$.data.id").alias("id")).distinct().count()
    assert spark.table("dim_cart").count() == ids
    spark.sql("DROP VIEW dim_cart")


@pytest.mark.parametrize("name", sorted(programs.JOBS.keys() - {"dim"}) + ["newest_lines"])
def test_every_job_has_a_stream_plan(spark, topics, name):
    sku, chain = _product_tables(spark)
    result = job_frame(name, topics[2], codes.code_dictionary(spark), sku, chain=chain)
    assert result.isStreaming
    out = output_frame(name, result)
    assert out.columns[0] in ("topic", "stt") and out.isStreaming


def test_published_operation_times_are_read_back(spark):
    text = '{"id":"77","row_op_ts":"2023-02-03 04:05:06.07Z","ts":"1675397106"}'
    row = spark.createDataFrame([(text,)], "value string").select(F.from_json("value", schemas.ORDER_DETAIL_RECORD).alias("r")).first().r
    assert (row.id, row.row_op_ts.microsecond, row.row_op_ts.second) == ("77", 70000, 6)
