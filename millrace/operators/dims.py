"""Configuration-driven dimension routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.scalars import keep_listed
from millrace.operators.asof import Versions, as_of_chunks, as_of_ranges
from millrace.operators.changelog import drop_control_records
from millrace.schemas import strings

#: What a configuration entry says about a source table.
CONFIG_ENTRY = ("sink_table", "sink_columns", "sink_pk")


def route_dimensions(changes: DataFrame, config: DataFrame, apply_deletes: bool = False) -> DataFrame:
    """Changes of configured tables as ``sink_table, sink_pk, data, op, ts`` with only the listed columns in ``data``.

    ``log_id``, the place in the topic, goes along where the changes have it: it orders changes of one second.

    Rows of tables without configuration are dropped. Deletes are passed on as ordinary versions unless
    ``apply_deletes`` asks for their ``op`` to be kept as 'd'.
    """
    entries = config.select(F.col("source_table").alias("_source"), *CONFIG_ENTRY)
    rows = drop_control_records(changes)
    return _routed(rows.join(entries, F.col("table") == F.col("_source"), "inner"), apply_deletes)


def _routed(rows: DataFrame, apply_deletes: bool) -> DataFrame:
    """Change records that carry their configuration, cut down to what the dimension tables store."""
    op = F.when((F.col("type") == "delete") & F.lit(apply_deletes), "d").otherwise("u")
    return rows.select(
        "sink_table",
        F.coalesce("sink_pk", F.lit("id")).alias("sink_pk"),
        keep_listed(F.col("data"), F.col("sink_columns")).alias("data"),
        op.alias("op"),
        "ts",
        *[c for c in rows.columns if c == "log_id"],
    )


def config_versions(changes: DataFrame, seq: Sequence[str] = ()) -> Versions:
    """Configuration change records as versions per source table; a delete ends what was in force. ``seq`` settles equal times."""
    entry = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    rows = changes.select(entry.alias("entry"), F.timestamp_millis("ts_ms").alias("since"), (F.col("op") == "d").alias("gone"), *seq)
    rows = rows.select("entry.source_table", *[f"entry.{c}" for c in CONFIG_ENTRY], "since", "gone", *seq)
    return Versions(rows, ["source_table"], "since", CONFIG_ENTRY, seq, "gone")


def route_dimensions_as_of(changes: DataFrame, config: Versions, apply_deletes: bool = False, chunked: bool = False) -> DataFrame:
    """As ``route_dimensions``, but each change by the configuration in force at its own time, so a log that is read again gives the same rows.

    ``chunked`` for configurations with too many versions to be broadcast.
    """
    rows = drop_control_records(changes).withColumn("_since", F.timestamp_seconds(F.col("ts").try_cast("bigint")))
    found = (as_of_chunks if chunked else as_of_ranges)(rows, config, ["table"], "_since", inner=True)
    return _routed(found, apply_deletes)


def dimension_schema(sink_columns: str) -> StructType:
    """All-text schema of a dimension table."""
    return StructType(strings(*sink_columns.split(",")))


def dimension_rows(routed: DataFrame, sink_table: str, sink_columns: str, *keep: str) -> DataFrame:
    """The routed rows of one dimension table as columns, with ``op`` and the change time ``_seconds``."""
    rows = routed.where(F.col("sink_table") == sink_table)
    columns = [F.col("data")[c].alias(c) for c in sink_columns.split(",")]
    return rows.select(*columns, "op", F.col("ts").try_cast("bigint").alias("_seconds"), *keep)
