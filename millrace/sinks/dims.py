"""Dimension tables: created from configuration, filled by routed changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.changelog import current_config, latest_by_key
from millrace.operators.dims import dimension_rows, route_dimensions
from millrace.schemas import TEXT_MAP, strings
from millrace.sinks.changelog import BatchWriter, append_changes

ROUTED = StructType(strings("sink_pk", "op", "ts", "log_id")).add("data", TEXT_MAP)


def quoted_name(name: str) -> str:
    """An identifier in SQL, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def quoted_text(text: str) -> str:
    """A text literal in SQL, whatever it holds."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dimension_ddl(path: str, sink_table: str, sink_columns: str, sink_pk: str | None = None, sink_extend: str | None = None) -> str:
    """Statement that makes a dimension readable by its name: the last version of each key among the stored changes.

    The key defaults to ``id`` and is recorded as a property, and so is ``sink_extend``. All names come from configuration and are quoted. Later changes
    show without a refresh, as the stored folder is listed anew by every query.
    """
    key = sink_pk or "id"
    names = ", ".join(f"_last.data[{quoted_text(name)}] AS {quoted_name(name)}" for name in sink_columns.split(","))
    properties = {"primary.key": key} | ({"sink.extend": sink_extend} if sink_extend else {})
    listed = ", ".join(f"{quoted_text(k)} = {quoted_text(v)}" for k, v in properties.items())
    return (
        f"CREATE OR REPLACE VIEW {quoted_name(sink_table)} TBLPROPERTIES ({listed}) AS SELECT {names} FROM ("
        f"SELECT max_by(struct(data, op), struct(batch_id, try_cast(ts AS BIGINT), log_id)) AS _last FROM parquet.{quoted_name(path)} "
        f"WHERE sink_table = {quoted_text(sink_table)} GROUP BY data[{quoted_text(key)}]) WHERE _last.op <> 'd'"
    )


def create_dimension(spark: SparkSession, path: str, entry) -> None:
    """Make the table that one configuration entry describes readable by its name; ``path`` must hold a batch of changes already."""
    spark.sql(dimension_ddl(path, entry["sink_table"], entry["sink_columns"], entry["sink_pk"], entry["sink_extend"]))


def dimension_writer(path: str) -> BatchWriter:
    """Store routed rows of all dimension tables in one write, one folder per table."""
    return append_changes(path, ["sink_table"])


def route_and_store(load_config: Callable[[], DataFrame], path: str) -> BatchWriter:
    """Route and store each micro-batch of the change log under the configuration in force when it starts.

    ``load_config`` returns the configuration changes so far; a table configured meanwhile is picked up by the next
    batch, without a restart. Each configured table is then readable by its name.
    """
    store = dimension_writer(path)
    known: dict[str, tuple] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        # one entry per table, written by hand; worked out once per batch
        config = current_config(load_config())
        entries = list(config.toLocalIterator())
        routed = route_dimensions(batch, F.broadcast(batch.sparkSession.createDataFrame(entries, config.schema)))
        if "log_id" not in routed.columns:
            routed = routed.withColumn("log_id", F.lit(None).cast("string"))
        store(routed, batch_id)
        if not known and batch.sparkSession.read.schema(ROUTED).parquet(path).isEmpty():
            return  # a view needs a first row to read its columns from
        for entry in entries:
            if known.get(entry["sink_table"]) != tuple(entry):
                create_dimension(batch.sparkSession, path, entry)
                known[entry["sink_table"]] = tuple(entry)

    return write


def read_dimension(spark: SparkSession, path: str, sink_table: str, sink_columns: str, pk: str = "id") -> DataFrame:
    """One dimension table as it stands; only its folders are read. Keys whose last change is a delete are absent."""
    stored = StructType([*ROUTED.fields]).add("batch_id", "long").add("sink_table", "string")
    routed = spark.read.schema(stored).parquet(path).where(F.col("sink_table") == sink_table)
    rows = dimension_rows(routed, sink_table, sink_columns, "batch_id", "log_id")
    return latest_by_key(rows, pk, ("batch_id", "_seconds", "log_id")).where("op <> 'd'").select(*sink_columns.split(","))
