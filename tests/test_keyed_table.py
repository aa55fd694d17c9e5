"""The table in buckets: what a batch rewrites, repeats, late versions, deletions and the plan of a read. And names in configuration that need quoting."""

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace import schemas
from millrace.sinks import dims
from millrace.sinks.keyed import KeyedTable
from millrace.sources import tables

SCHEMA = "id int, v int, at int, gone boolean"


def table(spark, path, **options):
    return KeyedTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, ["id"], ["at"], **{"buckets": 8, **options})


def held(kept):
    return sorted((r.id, r.v) for r in kept.read().collect())


def test_batches_in_any_order_end_in_the_last_versions(spark, tmp_path):
    rnd = random.Random(1)
    kept = table(spark, tmp_path / "t")
    assert held(kept) == []
    rows = [(rnd.randrange(40), k, rnd.randrange(1000), None) for k in range(300)]
    for batch_id in range(4):
        kept.write(spark.createDataFrame(rows[batch_id::4], SCHEMA), batch_id)
        kept.write(spark.createDataFrame([(0, -1, 5000, None)], SCHEMA), batch_id)  # a repeated batch changes nothing
    last = {}
    for batch_id in range(4):
        for r in rows[batch_id::4]:
            if r[0] not in last or r[2] >= last[r[0]][2]:
                last[r[0]] = r
    times = {k: v[2] for k, v in last.items()}
    assert {r.id: r["at"] for r in kept.read().collect()} == times
    again = table(spark, tmp_path / "t")
    assert held(again) == held(kept) and len(held(kept)) == len(last)


def test_a_batch_rewrites_its_buckets_only(spark, tmp_path):
    kept = table(spark, tmp_path / "t", deleted="gone")
    kept.write(spark.createDataFrame([(k, k, 0, False) for k in range(100)], SCHEMA), 0)
    kept.write(spark.createDataFrame([(7, 70, 1, False)], SCHEMA), 5)
    versions = kept.versions()
    assert sorted(set(versions.values())) == [0, 5] and list(versions.values()).count(5) == 1
    kept.write(spark.createDataFrame([(8, None, 2, True)], SCHEMA), 6)
    kept.write(spark.createDataFrame([(8, 80, 1, False)], SCHEMA), 7)  # older than the deletion
    assert held(kept) == sorted((k, 70 if k == 7 else k) for k in range(100) if k != 8)
    kept.write(spark.createDataFrame([], SCHEMA), 8)
    assert len(held(kept)) == 99
    plan = kept.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_names_with_quotes(spark, tmp_path):
    """Column and key names of any characters; extensions are kept as text. What the catalog can't have as a table name is refused, not run."""
    stored = str(tmp_path / "di'ms")
    name, column = "dim_quoted", "o'na`me"
    entry = {"source_table": "t", "sink_table": name, "sink_columns": f"id,{column},back\\slash", "sink_pk": "id", "sink_extend": "x'); DROP VIEW a; --"}
    config = spark.createDataFrame([(None, entry, "c", 1)], schemas.CONFIG_CHANGE)
    changes = spark.createDataFrame([("shop", "t", "insert", "1", {"id": "1", column: "it's", "back\\slash": "b"}, None)], schemas.CHANGE_LOG)
    dims.route_and_store(lambda: config, stored)(changes, 0)
    assert [tuple(r) for r in spark.table(dims.quoted_name(name)).collect()] == [("1", "it's", "b")]
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {dims.quoted_name(name)}").collect()}
    assert properties["sink.extend"] == entry["sink_extend"] and properties["primary.key"] == "id"
    spark.sql(f"DROP VIEW {dims.quoted_name(name)}")
    with pytest.raises(AnalysisException):
        spark.sql(dims.dimension_ddl(stored, "a` AS SELECT 1; --", "id"))


def test_configuration_is_loaded_once_per_batch(spark, tmp_path):
    loads = []
    rows = spark.createDataFrame([(None, {"source_table": "t", "sink_table": "dim_once", "sink_columns": "id", "sink_pk": None, "sink_extend": None}, "c", 1)], schemas.CONFIG_CHANGE)

    def load():
        loads.append(1)
        return rows

    changes = spark.createDataFrame([("shop", "t", "insert", "1", {"id": "1"}, None)], schemas.CHANGE_LOG)
    write = dims.route_and_store(load, str(tmp_path / "dims"))
    for batch_id in range(2):
        write(changes, batch_id)
    assert len(loads) == 2 and spark.table("dim_once").agg(F.count("id")).first()[0] == 1
    spark.sql("DROP VIEW dim_once")
    assert tables.config_snapshot(rows.select("after.*")).count() == 1
