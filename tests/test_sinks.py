"""What the writers store, repeat and read back."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import codes, schemas
from millrace.operators.joins import lookup_name
from millrace.operators.windows import keyword_count, stamped
from millrace.plans.programs import JOBS, newest_lines
from millrace.session import shared_dir
from millrace.sinks import changelog, dims, reports
from millrace.sources import kafka, tables

SCHEMA = "id string, v int"


def test_latest_versions_and_repeated_batches(spark, tmp_path):
    path = str(tmp_path / "facts")
    schema = spark.createDataFrame([], SCHEMA).schema
    write = changelog.append_changes(path)
    write(spark.createDataFrame([("a", 1), ("b", 1)], SCHEMA), 0)
    write(spark.createDataFrame([("a", 9)], SCHEMA), 10)
    write(spark.createDataFrame([("a", 2)], SCHEMA), 9)
    write(spark.createDataFrame([("a", 9)], SCHEMA), 10)
    assert changelog.read_changes(spark, path, schema).count() == 4
    latest = changelog.read_latest(spark, path, schema, "id")
    assert sorted(map(tuple, latest.collect())) == [("a", 9), ("b", 1)]
    target = str(tmp_path / "compacted")
    changelog.compact(spark, path, target, schema, "id")
    assert sorted(map(tuple, changelog.read_changes(spark, target, schema).collect())) == [("a", 9, 10), ("b", 1, 0)]
    changelog.append_changes(target)(spark.createDataFrame([("b", 5)], SCHEMA), 11)
    assert sorted(map(tuple, changelog.read_latest(spark, target, schema, "id").collect())) == [("a", 9), ("b", 5)]


def test_keyed_topic_form(spark):
    row = changelog.key_and_value(spark.createDataFrame([("a", 1)], SCHEMA), ["id"]).first()
    assert json.loads(row.key) == {"id": "a"} and json.loads(row.value) == {"id": "a", "v": 1}


def config(spark, *entries):
    rows = [
        (json.dumps({"op": op, "ts_ms": i, ("before" if op == "d" else "after"): {"source_table": t, "sink_table": f"dim_{t}", "sink_columns": c}}),)
        for i, (op, t, c) in enumerate(entries)
    ]
    return tables.config_changes(spark.createDataFrame(rows, "value string"))


def test_dimensions_follow_the_configuration(spark, tmp_path):
    """Two micro-batches; the second table is configured between them, without a restart."""
    inbox, stored = tmp_path / "in", str(tmp_path / "dims")
    entries = [("r", "brand", "id,name")]
    write = dims.route_and_store(lambda: config(spark, *entries), stored)
    checkpoint = shared_dir(spark, "dims")

    def arrive(*rows):
        frame = spark.createDataFrame([("shop", t, k, ts, d, None) for t, k, ts, d in rows], schemas.CHANGE_LOG)
        frame.coalesce(1).write.mode("append").parquet(str(inbox))
        stream = spark.readStream.schema(schemas.CHANGE_LOG).parquet(str(inbox))
        query = reports.start_stream(stream, checkpoint, write, interval=None)
        assert query.awaitTermination(120) and query.exception() is None

    arrive(
        ("brand", "insert", "1", {"id": "1", "name": "old", "logo": "x"}),
        ("brand", "update", "2", {"id": "1", "name": "new", "logo": "x"}),
        ("region", "insert", "1", {"id": "7"}),
        ("brand", "bootstrap-start", "1", {}),
    )
    entries.append(("c", "region", "id"))
    arrive(("region", "insert", "3", {"id": "8"}), ("brand", "insert", "3", {"id": "2", "name": "two"}))
    brands = dims.read_dimension(spark, stored, "dim_brand", "id,name")
    assert sorted(map(tuple, brands.collect())) == [("1", "new"), ("2", "two")]
    assert [tuple(r) for r in dims.read_dimension(spark, stored, "dim_region", "id").collect()] == [("8",)]
    plan = brands._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sink_table" in plan


@pytest.mark.parametrize("turned", [False, True])
def test_dimension_tables_are_read_by_name(spark, tmp_path, turned):
    """The configuration makes the table; the later change of a second wins, in whatever order the rows reach the task."""
    path = str(tmp_path / "dims")
    entries = [("c", "made", "id,name")]
    write = dims.route_and_store(lambda: config(spark, *entries), path)
    schema = T.StructType([*schemas.CHANGE_LOG.fields, T.StructField("log_id", T.StringType())])

    def arrive(batch_id, *rows):
        rows = [("shop", "made", "update", ts, {"id": k, "name": name}, None, log_id) for log_id, ts, k, name in rows]
        write(spark.createDataFrame(rows[::-1] if turned else rows, schema).coalesce(1), batch_id)

    arrive(0)
    arrive(1, ("0-1", "5", "1", "old"), ("0-2", "5", "1", "new"), ("0-3", "4", "2", "two"))
    assert spark.table("dim_made").dtypes == [("id", "string"), ("name", "string")]
    assert sorted(map(tuple, spark.table("dim_made").collect())) == [("1", "new"), ("2", "two")]
    assert sorted(map(tuple, dims.read_dimension(spark, path, "dim_made", "id,name").collect())) == [("1", "new"), ("2", "two")]
    entries.append(("u", "made", "id"))
    arrive(2, ("0-4", "6", "3", "three"))
    assert sorted(map(tuple, spark.table("dim_made").collect())) == [("1",), ("2",), ("3",)]
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES dim_made").collect()}
    assert properties["primary.key"] == "id"
    spark.sql("DROP VIEW dim_made")


@pytest.mark.parametrize("turned", [False, True])
def test_newest_line_of_equal_times_is_the_later_arrival(spark, turned):
    rows = [("1", "a", 5, "0-1"), ("1", "b", 5, "0-2"), ("1", "c", 4, "0-3")]
    lines = spark.createDataFrame(rows[::-1] if turned else rows, "id string, v string, row_op_ts long, log_id string").coalesce(1)
    assert [r.v for r in newest_lines(lines).collect()] == ["b"]


def test_dictionary_that_grows_between_batches(spark, tmp_path):
    path, got = str(tmp_path / "dic"), []
    add = lambda *codes: spark.createDataFrame([(c, f"name {c}") for c in codes], schemas.DICTIONARY).write.mode("append").parquet(path)
    rule = lambda batch, side: lookup_name(batch, side, "code", "name")
    write = tables.with_fresh(lambda: tables.load_dictionary(spark, path), rule, lambda df, _: got.append({r.name for r in df.collect()}))
    facts = spark.createDataFrame([("1",), ("2",)], "code string")
    add("1")
    write(facts, 0)
    add("2")
    write(facts, 1)
    assert got == [{"name 1"}, {"name 1", "name 2"}]
    assert "strategy=broadcast" not in facts.join(tables.broadcast_if_small(facts, max_bytes=5), "code")._jdf.queryExecution().optimizedPlan().toString()


def test_report_columns_in_order_without_skipped_ones(spark, tmp_path):
    path = str(tmp_path / "report")
    frame = spark.createDataFrame([(1, 2, 3)], "c int, a int, b int")
    write = reports.report_writer(("a", "b", "c"), "parquet", skip=("b",), path=path)
    write(frame, 0)
    write(frame, 1)
    stored = spark.read.parquet(path)
    assert stored.columns == ["a", "c"] and stored.count() == 2


def test_report_stream(spark, folder, tmp_path):
    path = str(tmp_path / "out")
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "documents.parquet").parquet(folder)
    rows = stamped(stream.select("doc_id", "lang"))
    query = reports.start_stream(rows, shared_dir(spark, "report"), reports.report_writer(("doc_id", "ts"), "parquet", path=path), interval=None)
    assert query.awaitTermination(120) and query.exception() is None
    stored = spark.read.parquet(path)
    assert stored.columns == ["doc_id", "ts"] and stored.where("ts IS NULL").count() == 0


def test_topic_rows(spark):
    frame = spark.createDataFrame([("a", 1)], SCHEMA)
    keyed = reports.topic_frame(frame, "t", ["id"]).first()
    assert (keyed.topic, json.loads(keyed.key), json.loads(keyed.value)) == ("t", {"id": "a"}, {"id": "a", "v": 1})
    assert reports.topic_frame(frame, "t").first().key is None
    fan_out = spark.createDataFrame([("x", "{}", 1)], "topic string, value string, other int")
    assert reports.topic_frame(fan_out).columns == ["topic", "value"]


def test_connector_options():
    options = kafka.kafka_options("host:9092", "topic_log")
    assert options["subscribe"] == "topic_log" and int(options["maxOffsetsPerTrigger"]) > 0
    assert reports.topic_options("host:9092")["kafka.transaction.timeout.ms"] == "900000"
    assert tables.jdbc_options("jdbc:x", "base_dic", user="u") == {"url": "jdbc:x", "dbtable": "base_dic", "user": "u"}


def test_dictionary_file_and_broadcast_check(spark, tmp_path):
    codes.code_dictionary(spark).write.parquet(str(tmp_path / "dic"))
    dictionary = tables.load_dictionary(spark, str(tmp_path / "dic"))
    assert dictionary.count() == len(codes.CODE_NAMES)
    facts = spark.range(10).withColumn("dic_code", F.lit("1001")).hint("merge")

    def plan(max_rows):
        joined = facts.join(tables.broadcast_if_small(dictionary.repartition(2), max_rows), "dic_code")
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(1000) and "strategy=broadcast" not in plan(3)


def test_jobs_are_complete():
    assert len(JOBS) == 17
    assert all(job.target for job in JOBS.values())


def test_keyword_count(spark):
    texts = spark.createDataFrame([("Red ring",), ("red",), (None,), ("",)], "text string")
    assert sorted(map(tuple, keyword_count(texts, "text").collect())) == [("red", 2), ("ring", 1)]
